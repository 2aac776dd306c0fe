"""Periodic runs of words: found by recursive frequency splitting and a lag scan, then collapsed.

A run is a stretch of words with smallest period q (words q apart are equal) that is at least
``times`` periods and ``least`` words long and that no neighbouring word extends.

1. *Splitting.* Each word of a run occurs ``times`` times in it. A word that occurs less often in
   its segment, at first the text, is in no run of that segment, so it splits it; the parts are
   counted again until no segment changes. Text without runs dissolves in a few turns. Runs keep
   whole: a word that extended one would be part of it, and would not split.
2. *Lag scan.* What survives is scanned for the lags of one octave after the other. For lags from
   ``size / 2 + 1`` to ``size``, a power of two, each place gets the name of the ``size`` words from
   there (pairs of names of half the size) and the distance to where that name comes next in its
   segment. Where as many words as a period, or more, come again after q words and not before,
   q is the smallest period; so places in a row with one distance q are exactly one run of period
   q, of ``size + q - 1`` words more than places. Each octave costs a sort, however long the text.

All of it works on numbers for words that are equal where the words are, so results are exact. Many
texts are treated at once, about a megabyte of them; a longer text is treated alone.

Null text has no words, no runs and collapses to an empty text, as an empty one does. Rows that
repeat are treated each. No rows: no result. Other columns are kept; one named as the result is
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BYTES = 1_000_000
FOUND = "starts array<bigint>, lengths array<bigint>, periods array<bigint>, kept string"


def surviving(word: np.ndarray, segment: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places, and their segments, that are left when words too rare in their segment have split it."""
    place = np.arange(len(word))
    kept = [(place[:0], segment[:0])]
    number = 0
    while len(place):
        key = segment * (int(word.max()) + 1) + word[place]
        _, own, count = np.unique(key, return_inverse=True, return_counts=True)
        stay = count[own] >= times
        changed = np.bincount(segment, ~stay, int(segment[-1]) + 1)[segment] > 0
        kept.append((place[~changed], segment[~changed] + number))
        number += int(segment[-1]) + 1
        place, segment = place[stay & changed], segment[stay & changed]
        if len(place):
            cut = (np.diff(place) > 1) | (np.diff(segment) != 0)
            segment = np.concatenate([[0], np.cumsum(cut)])
            long = np.bincount(segment)[segment] >= least
            place, segment = place[long], segment[long]
            segment = np.unique(segment, return_inverse=True)[1]
    place, segment = (np.concatenate(x) for x in zip(*kept, strict=True))
    order = np.argsort(place, kind="stable")
    return place[order], segment[order]


def lag_scan(word: np.ndarray, place: np.ndarray, segment: np.ndarray, times: int, least: int) -> np.ndarray:
    """Start, length and period of each run within the segments, in no order."""
    found = [np.empty((0, 3), np.int64)]
    size = 1
    name = np.unique(segment * (int(word.max(initial=0)) + 1) + word[place], return_inverse=True)[1]
    edge = np.flatnonzero(np.diff(segment)) + 1
    ends = np.concatenate([edge, [len(segment)]])
    left = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(segment))  # words to the segment's end
    length = np.repeat(np.diff(np.concatenate([[0], ends])), np.diff(np.concatenate([[0], ends])))
    while True:
        worth = length >= max(least, times * (size // 2 + 1))
        place, segment, name, left, length = (x[worth] for x in (place, segment, name, left, length))
        if not len(place):
            return np.concatenate(found)
        order = np.argsort(name, kind="stable")
        same = np.flatnonzero(name[order[1:]] == name[order[:-1]])
        lag = np.zeros(len(place), np.int64)
        lag[order[same]] = place[order[same + 1]] - place[order[same]]
        lag[(lag <= size // 2) | (lag > size)] = 0
        begin = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(segment) != 0) | (np.diff(lag) != 0)])
        first = np.flatnonzero(begin)
        count = np.diff(np.append(first, len(place)))
        q = lag[first]
        runs = np.stack([place[first], count - 1 + size + q, q], axis=1)
        found.append(runs[(q > 0) & (runs[:, 1] >= np.maximum(least, times * q))])
        # names of twice the size, where the segment has so many words left
        on = np.flatnonzero(left >= 2 * size)
        pair = name[on] * (int(name.max()) + 1) + name[on + size] if len(on) else on
        place, segment, left, length = place[on], segment[on], left[on], length[on]
        name = np.unique(pair, return_inverse=True)[1]
        size *= 2


def runs_of(texts: list[list[bytes]], times: int = 4, least: int = 6) -> list[np.ndarray]:
    """For each list of words its runs, ordered by start and period: start, length, period."""
    sizes = np.array([len(words) for words in texts], np.int64)
    number: dict[bytes, int] = {}
    flat = [number.setdefault(w, len(number)) for words in texts for w in words]
    word = np.array(flat, np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    if not len(word):
        return [np.empty((0, 3), np.int64) for _ in texts]
    runs = lag_scan(word, *surviving(word, np.unique(text, return_inverse=True)[1], times, least), times, least)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = text[runs[:, 0]]
    runs[:, 0] -= begin[owner]
    return np.split(runs, np.searchsorted(owner, np.arange(1, len(texts))))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one blank."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def _some(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, so many at a time that their bytes stay few."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) < _BYTES):
            size += len(texts[end])
            end += 1
        yield texts[start:end]
        start = end


def with_periods(documents: DataFrame, name: str = "periodic", times: int = 4, least: int = 6) -> DataFrame:
    """The documents with a struct: starts, lengths and periods of the runs, and the collapsed text.

    ``times`` must be 3 or more: the octaves of the scan look at up to three periods in a row.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for some in _some([(t or "").encode("utf-8", "surrogatepass") for t in batch]):
                texts = [t.split() for t in some]  # bytes are split at ASCII white space
                for words, runs in zip(texts, runs_of(texts, times, least), strict=True):
                    text = collapsed(words, runs).decode("utf-8", "surrogatepass")
                    out.append((*runs.T, text))
            yield pd.DataFrame(out, columns=["starts", "lengths", "periods", "kept"])

    return documents.withColumn(name, F.pandas_udf(find, FOUND)("text"))
