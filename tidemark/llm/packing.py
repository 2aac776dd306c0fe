"""Packing documents into sequences of equal length.

A task turns each text to token ids and cuts it into windows: full ones, each a sequence of its
own, and one shorter rest. What remains depends on the rests' lengths only, so it is planned from
their histogram, which has ``window - 1`` numbers however many documents there are:

1. All combinations of two or three lengths that fill a window exactly are enumerated.
2. Non-negative least squares finds how often each should repeat to use up the histogram.
3. The repeats are rounded, the largest first and never beyond what is there.
4. What is left is packed greedily: the longest length with the longest that still fit, as often
   as the histogram allows.

A piece's place follows from its rank among the pieces of its length: ranks are dealt to the
combinations in ranges. Pieces are ranked by one range-sort, so a length that a third of all
documents share is spread over the tasks.

Ids come from a byte-level BPE. Its vocabulary as ranks encodes most texts, each as a whole. Texts with runs of
white space, special tokens, letters beyond Latin or very long words go to the tokenizer itself. Tests hold both
against the tokenizer on whole tables.

Null and empty texts consist of the end id alone. Rows that repeat an id are packed each. Other
columns are ignored. No rows: no result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held, ranked, small_batches, stored

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint"
END = 1
# a longer stretch without a blank takes the ranks more time than the tokenizer
_UNIT = 1000
# outside of these, or where white space runs on, the ranks may cut in another way
_ODD = re.compile(r" \s| $|[^\x09-\x0d\x20-\x7e\xa1-ɏ]|<\|")


class Encoder:
    """Token ids of texts."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if text and (_ODD.search(text) or max(map(len, text.split(" "))) > _UNIT):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.ranks.encode_ordinary(text), np.uint32)


def pieces(documents: DataFrame, vocabulary: str, ranks: str, pattern: str, window: int) -> DataFrame:
    """The windows each document is cut into."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = vocabulary, ranks, pattern
        encoder = held(("encoder", *files), lambda: Encoder(*files))
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encoder.ids(text or ""), np.uint32(END)).astype("<u4", copy=False)
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    out.append((doc, start, len(part), zlib.crc32(part), len(ids)))
            frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield frame.astype({"doc_id": "Int64"})

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(cut, PIECES)


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """All triples of present lengths that fill a window, and pairs, with 0 as the third."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    has[0] = True
    found = []
    for a in present[::-1].tolist():
        second = np.arange((window - a + 1) // 2, min(a, window - a) + 1)
        third = window - a - second
        ok = has[second] & has[third] & (second >= third) & (second > 0)
        found.append(np.stack([np.full(ok.sum(), a), second[ok], third[ok]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def nonnegative_least_squares(groups: np.ndarray, wanted: np.ndarray, turns: int = 300) -> np.ndarray:
    """Repeats of each combination, none negative, so that the lengths used come near the histogram.

    Multiplicative steps; each lowers the squared error and keeps the signs.
    """
    weight = wanted.astype(float)
    weight[0] = 0
    repeats = np.full(len(groups), weight.sum() / max(1, 3 * len(groups)))
    aim = weight[groups].sum(axis=1)
    for _ in range(turns):
        used = sum(np.bincount(groups[:, i], repeats, len(weight)) for i in range(3))
        used[0] = 0
        repeats = repeats * aim / np.maximum(used[groups].sum(axis=1), 1e-12)
    return repeats


def plan(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Groups of lengths, longest first, and how often each is used; together the histogram."""
    left = histogram.copy()
    out = [((window,), int(left[window]))] if left[window] else []
    left[window] = 0
    groups = combinations(np.flatnonzero(left), window)
    repeats = nonnegative_least_squares(groups, left)
    order = np.argsort(-repeats, kind="stable")
    order = order[repeats[order] >= 0.5]
    for group, times in zip(groups[order].tolist(), np.rint(repeats[order]).astype(int).tolist(), strict=True):
        group = tuple(x for x in group if x)
        times = min(times, *(left[x] // group.count(x) for x in set(group)))
        if times > 0:
            out.append((group, int(times)))
            for x in group:
                left[x] -= times
    while left.any():  # each turn uses up a length, all but what its count leaves over
        have, group, room = left.copy(), [], window
        while room > 0:
            fit = np.flatnonzero(have[: room + 1])
            if not len(fit):
                break
            longest = int(fit[-1])
            times = min(room // longest, int(have[longest]))
            group += [longest] * times
            have[longest] -= times
            room -= longest * times
        times = int(min(left[x] // group.count(x) for x in set(group)))
        out.append((tuple(group), times))
        for x in group:
            left[x] -= times
    return out


def _ranges(groups: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: first rank, first sequence, pieces of this length in each, offset of the first."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    dealt: dict[int, int] = {}
    sequence = 0
    for group, times in groups:
        offset = 0
        for length in dict.fromkeys(group):
            each = group.count(length)
            rows.setdefault(length, []).append((dealt.get(length, 0), sequence, each, offset))
            dealt[length] = dealt.get(length, 0) + each * times
            offset += each * length
        sequence += times
    return {length: np.array(x) for length, x in rows.items()}


def packed(
    documents: DataFrame, folder: str, vocabulary: str, ranks: str, pattern: str, window: int = 2048
) -> DataFrame:
    """One row per piece: where its ids come from and where they lie."""
    with small_batches(documents.sparkSession):
        cut = stored(pieces(documents, vocabulary, ranks, pattern, window), f"{folder}/pieces")
    counts = dict(cut.groupBy("length").count().collect())  # at most as many as a window has tokens
    histogram = np.zeros(window + 1, np.int64)
    histogram[list(counts)] = list(counts.values())
    ranges = _ranges(plan(histogram, window))
    shorter = np.concatenate([[0], np.cumsum(histogram)])
    order = ranked(cut, ["length", "doc_id", "start"], f"{folder}/order")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for length, rows in batch.groupby("length", sort=False):
                known, rank = ranges[length], rows["rank"].to_numpy() - shorter[length]
                first, sequence, each, offset = known[np.searchsorted(known[:, 0], rank, side="right") - 1].T
                rows = rows.assign(sequence_id=sequence + (rank - first) // each)
                out.append(rows.assign(offset=offset + (rank - first) % each * length))
            if out:
                yield pd.concat(out)[names].astype({"doc_id": "Int64"})

    names = [x.split()[0] for x in PACKED.split(", ")]
    return order.mapInPandas(place, PACKED)
