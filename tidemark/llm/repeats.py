"""Suffix-array dedup: bytes covered by strings of ``length`` bytes that start elsewhere as well.

Every window of ``length`` bytes is filed under an anchor, a piece of it chosen by hash, so equal
windows meet under one anchor hash, at the same distance from the anchor. Runs of windows with one
anchor are contexts. Contexts whose anchor hash occurs once are done: their windows are unique.
Copies of a context settle each other. What is left are contexts that occur once and share their
anchor with others: the edges of repeated passages. Those of one anchor are cut to what they share
with a neighbour on either side, the part all of them share becomes one symbol, and a suffix array
over them (``suffixes.py``), with the common prefixes of neighbours in it, tells which windows start
elsewhere too. Anchors with more than ``most`` different contexts, such as the edge of a passage
that a third of all documents hold, are decided by counting digests of their windows instead: rows
that Spark adds up before it moves them, so no task holds such an anchor's contexts.

Strings are judged on the input. Matches never cross documents. Null and short texts lose nothing.
Rows that repeat an id are documents of their own, told apart by a hash of the text; rows repeated
in full are copies of each other. Null ids are documents like any other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import Prefixes, filed
from tidemark.llm.common import dropped, stored
from tidemark.llm.suffixes import common_prefixes, suffix_array

GRAM = 64
_AT = "doc_id bigint, th int"
_BATCH = 1_000_000


def _data(batch: pd.DataFrame) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Rows of a batch, few enough at a time, with their texts' bytes and where each starts."""
    rows, parts, size = [], [], 0
    for i, text in enumerate(batch["text"]):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if rows and size + len(raw) > _BATCH:
            yield rows, *_flat(parts)
            rows, parts, size = [], [], 0
        rows.append(i)
        parts.append(raw)
        size += len(raw)
    if rows:
        yield rows, *_flat(parts)


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum(sizes))


def _contexts(length: int):
    """The contexts of documents: anchor hash, context hash, document, first and last start, anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, hashes = batch["doc_id"].to_numpy(), batch["th"].to_numpy()
            for rows, data, bounds in _data(batch):
                if len(data) < length:
                    continue
                if len(data) >= 1 << 24:  # one long text: pieces that overlap by a window less a byte
                    parts = [(rows[0], s, data[s : s + _BATCH + length - 1]) for s in range(0, len(data), _BATCH)]
                else:
                    parts = [(None, 0, data)]
                for row, shift, part in parts:
                    if len(part) < length:
                        continue
                    edges = bounds if row is None else np.array([0, len(part)])
                    text, h, first, last, at, ctx = filed(part, edges, length, GRAM)
                    where = np.array(rows)[text] if row is None else np.full(len(text), row)
                    yield pd.DataFrame(
                        {
                            "h": h.view(np.int64),
                            "ctx": ctx.view(np.int64),
                            "doc_id": ids[where],
                            "th": hashes[where],
                            "f": first + shift,
                            "l": last + shift,
                            "o": at,
                        }
                    ).astype({"doc_id": "Int64"})

    return run


def _common(a: bytes, b: bytes) -> int:
    """How many bytes two strings share from the start."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def _reach(parts: list[bytes]) -> tuple[list[int], int]:
    """For each string the longest start it shares with another; and what all share."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for i, j in zip(order, order[1:], strict=False):
        shared = _common(parts[i], parts[j])
        out[i], out[j] = max(out[i], shared), max(out[j], shared)
    return out, _common(parts[order[0]], parts[order[-1]])


def repeated_starts(contexts: list[tuple[bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """For contexts of one anchor (bytes, place of the anchor): runs of starts of windows that another has."""
    if len(contexts) < 2:
        return [[] for _ in contexts]
    left, core_left = _reach([raw[:at][::-1] for raw, at in contexts])
    right, core_right = _reach([raw[at:] for raw, at in contexts])
    use = [i for i in range(len(contexts)) if left[i] + right[i] >= length]
    symbols: list[int] = []
    origin: list[tuple[int, int]] = []
    for n, i in enumerate(use):
        raw, at = contexts[i]
        head = raw[at - left[i] : at - core_left]
        tail = raw[at + core_right : at + right[i]]
        origin += [(i, at - left[i] + k) for k in range(len(head))]
        origin.append((i, at - core_left))
        origin += [(i, at + core_right + k) for k in range(len(tail) + 1)]
        # bytes from 1 up, the core above them, an end of its own for each context below them
        symbols += [x + len(use) + 1 for x in head]
        symbols.append(len(use) + 300)
        symbols += [x + len(use) + 1 for x in tail]
        symbols.append(len(use) - n)
    symbols.append(0)
    origin.append((-1, 0))
    order = suffix_array(symbols)
    shared = common_prefixes(symbols, order)
    best: list[int] = [0] * len(symbols)
    for k in range(1, len(order)):
        for at in (order[k - 1], order[k]):
            best[at] = max(best[at], shared[k])
    core = core_left + core_right
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    at = 0
    for i in use:
        raw, anchor = contexts[i]
        first, middle = anchor - left[i], anchor - core_left
        starts = []
        for k in range(middle - first):
            n = best[at + k]
            if n > middle - first - k and n + core - 1 >= length:  # the core counts as one symbol
                starts.append(first + k)
        # from within the core, as far as the core's own suffix goes
        n = best[at + middle - first] + core - 1
        reach = middle + n - length
        starts += range(middle, min(reach, anchor) + 1)
        at += middle - first + 1 + (right[i] - core_right) + 1
        starts = [x for x in starts if x + length <= len(raw)]
        for x in starts:
            if out[i] and out[i][-1][1] == x - 1:
                out[i][-1] = (out[i][-1][0], x)
            else:
                out[i].append((x, x))
    return out


def _decided(length: int):
    """Runs of repeated starts in the contexts that occur once; rows come sorted by anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def decide(rows: list[tuple]) -> list[tuple]:
            found = repeated_starts([(r[6], r[5]) for r in rows], length)
            return [
                (r[1], r[2], r[3] + a, r[3] + b) for r, runs in zip(rows, found, strict=True) if r[4] == 1 for a, b in runs
            ]

        held: list[tuple] = []
        for batch in batches:
            out = []
            for r in batch[["h", "doc_id", "th", "f", "c", "o", "raw"]].itertuples(index=False, name=None):
                if held and held[0][0] != r[0]:
                    out += decide(held)
                    held = []
                held.append(r)
            yield _spans(out)
        if held:
            yield _spans(decide(held))

    return run


def _spans(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "th", "f", "l"]).astype({"doc_id": "Int64"})


def _windows(length: int):
    """Each window of contexts: anchor, distance from it, two digests, and where it starts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                data = np.frombuffer(r.raw, np.uint8)
                a = np.arange(len(data) - length + 1)
                prefixes = Prefixes(data)
                one, two = prefixes.of(a, a + length, 11), prefixes.of(a, a + length, 12)
                yield pd.DataFrame(
                    {
                        "h": r.h,
                        "one": one.view(np.int64),
                        "two": two.view(np.int64),
                        "c": r.c,
                        "doc_id": r.doc_id,
                        "th": r.th,
                        "f": a + r.f,
                    }
                ).astype({"doc_id": "Int64"})

    return run


def repeated_spans(documents: DataFrame, folder: str, length: int = 200, most: int = 20_000) -> DataFrame:
    """Runs of starts of repeated windows: doc_id, th (a hash of the text), f, l (first and last start)."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.hash("text").alias("th"), "text")
    contexts = rows.where(F.octet_length("text") >= length).mapInPandas(
        _contexts(length), f"h bigint, ctx bigint, {_AT}, f int, l int, o int"
    )
    contexts = stored(contexts, f"{folder}/contexts")
    again = contexts.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    # stored, so that the join deals both sides anew and Spark can split the rows of a frequent anchor
    again = stored(again, f"{folder}/again")
    shared = stored(contexts.join(again, "h"), f"{folder}/shared")
    dropped(documents.sparkSession, f"{folder}/contexts")
    distinct = shared.groupBy("h", "ctx").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "f", "l", "o")).alias("r"))
    distinct = stored(distinct.select("h", "ctx", "c", "r.*"), f"{folder}/distinct")
    copies = distinct.where("c > 1").select("h", "ctx")
    settled = shared.join(copies, ["h", "ctx"], "left_semi").select("doc_id", "th", "f", "l")

    kinds = distinct.groupBy("h").agg(F.count("*").alias("m"), F.min("c").alias("least")).where("m > 1 and least = 1")
    open_ = distinct.join(kinds.select("h", "m"), "h")
    one = F.struct("h", "c", "f", "l", "o", "m")
    open_ = open_.groupBy("doc_id", "th").agg(F.collect_list(one).alias("open"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, th, text, h, c, f, last, o, m in batch.itertuples(index=False, name=None):
                raw = text.encode("utf-8", "surrogatepass")
                for row in zip(h.tolist(), c.tolist(), f.tolist(), last.tolist(), o.tolist(), m.tolist(), strict=True):
                    out.append((row[0], doc, th, row[2], row[1], row[4], row[5], raw[row[2] : row[3] + length]))
            names = ["h", "doc_id", "th", "f", "c", "o", "m", "raw"]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    met = rows.withColumnsRenamed({"doc_id": "d", "th": "t"}).join(
        open_, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    )
    fields = [f"open.{x}" for x in ("h", "c", "f", "l", "o", "m")]
    pieces = met.select("doc_id", "th", "text", *fields).mapInPandas(
        cut, f"h bigint, {_AT}, f int, c bigint, o int, m bigint, raw binary"
    )
    pieces = stored(pieces, f"{folder}/pieces")
    few = pieces.where(F.col("m") <= most).repartition("h").sortWithinPartitions("h")
    decided = few.mapInPandas(_decided(length), f"{_AT}, f int, l int")
    windows = pieces.where(F.col("m") > most).mapInPandas(
        _windows(length), f"h bigint, one bigint, two bigint, c bigint, {_AT}, f int"
    )
    windows = stored(windows, f"{folder}/windows")
    twice = windows.groupBy("h", "one", "two").agg(F.count("*").alias("n")).where("n > 1")
    counted = windows.where("c = 1").join(twice, ["h", "one", "two"], "left_semi")
    counted = counted.select("doc_id", "th", "f", F.col("f").alias("l"))
    return settled.unionByName(decided).unionByName(counted)


def without_repeats(documents: DataFrame, folder: str, length: int = 200) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = stored(repeated_spans(documents, folder, length), f"{folder}/spans")
    spans = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("f", "l")).alias("s"))
    spans = spans.select("doc_id", "th", "s.f", "s.l")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("d"), F.hash("text").alias("t"), "text")
    met = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    rows = rows.join(spans, met, "left").select(F.col("d").alias("doc_id"), "text", "f", "l")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, first, last in batch.itertuples(index=False, name=None):
                raw = (text or "").encode("utf-8", "surrogatepass")
                gone = spans_n = 0
                if first is not None and len(first):
                    order = np.argsort(first)
                    a, b = np.asarray(first)[order], np.maximum.accumulate(np.asarray(last)[order] + length)
                    new = np.append(True, a[1:] > b[:-1])
                    begin, end = a[new], b[np.append(np.flatnonzero(new)[1:], len(a)) - 1]
                    gone, spans_n = int((end - begin).sum()), len(begin)
                    edges = zip([0, *end.tolist()], [*begin.tolist(), len(raw)], strict=True)
                    kept = b"".join(raw[x:y] for x, y in edges)
                else:
                    kept = raw
                out.append((doc, len(raw), gone, spans_n, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return rows.mapInPandas(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
