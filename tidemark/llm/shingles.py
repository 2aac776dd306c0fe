"""Word shingles of many texts at once, as 64-bit hashes, with numpy only.

All texts of a batch are joined to one byte array. A word's hash is a polynomial over its
bytes, taken from one running sum; a shingle's hash mixes the hashes of its words.
"""

from __future__ import annotations

import numpy as np

_FACTOR = 0x9E3779B97F4A7C15 | 1
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def grown(table: np.ndarray, factor: int, size: int) -> np.ndarray:
    """The powers 0..size-1 of an odd factor modulo 2**64."""
    while len(table) < size:
        step = np.uint64(pow(factor, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other in a byte array.

    ``bounds`` holds where each text starts, and the end of the last. A white-space byte must
    follow each text. ``gap`` tells which bytes are in no word. Returns the hashes and, for each
    text, where its words start among them (one entry more than texts). Letters A-Z count as a-z.
    """
    global _powers, _inverse
    _powers = grown(_powers, _FACTOR, len(data) + 1)
    _inverse = grown(_inverse, pow(_FACTOR, -1, 1 << 64), len(data) + 1)
    inside = ~gap[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=total[1:])
    plain = (total[ends] - total[starts]) * _inverse[starts]
    return mix(plain + (ends - starts).astype(np.uint64)), np.searchsorted(starts, bounds)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, a line feed after each, and where each starts (and the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return data, np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending.

    A text of fewer words than ``width`` has its whole word sequence as its only shingle; one
    without words has none.
    """
    out: list[np.ndarray] = []
    start = 0
    while start < len(texts):  # so many at a time that the arrays stay small
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) < 250_000):
            size += len(texts[end])
            end += 1
        out += _sets(texts[start:end], width)
        start = end
    return out


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    words, first = word_hashes(*joined(texts))
    factor = np.uint64(0xD6E8FEB86659FD93)
    n = max(0, len(words) - width + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(width):
        rolled = rolled * factor + words[i : i + n]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            own = np.sort(rolled[a : b - width + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            short = np.array([b - a], np.uint64)
            for w in words[a:b]:
                short = short * factor + w  # wraps around, as it should
            sets.append(mix(short))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
