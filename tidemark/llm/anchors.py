"""Windows of bytes and the anchor each of them is filed under, with numpy only.

Every window of ``length`` bytes has one anchor: the leftmost of its ``gram``-byte pieces
whose hash is smallest. Equal windows have equal anchors at equal places, so they need only
be compared with windows of the same anchor hash.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.shingles import grown, mix

_FACTOR = 0xD1342543DE82EF95
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


class Prefixes:
    """Hashes of any piece of a byte array, from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        global _powers, _inverse
        _powers = grown(_powers, _FACTOR, len(data) + 1)
        _inverse = grown(_inverse, pow(_FACTOR, -1, 1 << 64), len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
        """Hashes of data[start:end]: equal for equal pieces, in whatever array and wherever they lie."""
        plain = (self._sums[ends] - self._sums[starts]) * _inverse[starts]
        return mix(plain ^ np.uint64(seed)) ^ (ends - starts).astype(np.uint64)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the place of its leftmost smallest value.

    Of the values the upper 40 bits count; the lower 24 make room for the place, so there may be
    2**24 values at most.
    """
    if len(values) >= 1 << 24:
        raise ValueError("too many values at a time")
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low = np.uint64((1 << 24) - 1)
    least = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span * 2 <= width:  # the smallest of the next ``span`` values, doubled
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return (np.minimum(least[:n], least[width - span : width - span + n]) & low).astype(np.int64)


def filed(data: np.ndarray, bounds: np.ndarray, length: int, gram: int, seed: int = 0) -> tuple[np.ndarray, ...]:
    """Runs of window starts that share an anchor, for texts that lie one after the other.

    ``bounds`` holds where each text starts, and the end of the last. Returns, for each run: the
    text's number, the anchor's hash, the first and the last start within the text, how far behind
    the first start the anchor lies, and a hash of the bytes that the run's windows cover.
    """
    prefixes = Prefixes(data)
    grams = np.arange(max(0, len(data) - gram + 1))
    hashes = prefixes.of(grams, grams + gram, seed)
    place = leftmost_minima(hashes, length - gram + 1)
    sizes = np.maximum(0, np.diff(bounds) - length + 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + bounds[owner]
    at = place[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    a, b, p, text = starts[first], starts[last], at[first], owner[first]
    covered = prefixes.of(a, b + length, seed + 1) ^ mix((p - a).astype(np.uint64))
    return text, hashes[p], a - bounds[text], b - bounds[text], p - a, covered
