"""Benchmark decontamination by winnowing.

Words of documents that lie in a passage of ``span`` words which an item of a benchmark also has are
found. An item of fewer words is one passage as a whole.

1. *Winnowing.* A text's k-grams of words are hashed, and of each window of ``span - k + 1`` grams
   in a row, which covers ``span`` words, the one with the smallest hash stands (the first of
   equal ones). The choice depends on the words of the window only, so a passage that two texts
   share has the same fingerprint in both. Items shorter than ``span`` are winnowed by their own
   length, and documents once more for each such length that occurs, at most ``span - 1``.
2. *Lookup.* A table of fixed size (2**24 bits, built by Spark) tells which fingerprints no item
   has. Windows with another one than that are all that leaves the scan of the documents. When a
   benchmark is so large that the table is full, more windows pass; results stay the same.
3. *Join and extend.* Windows meet on the fingerprint and on what extends it, the hash of all words of the
   window (128 bits), so a gram that many texts share brings no pairs of unlike windows together.
   Windows that are found in a document are united to spans.

Equal texts are joined once. A window that many documents have meets one row for it; items come in
after that, one row for each document and item.

Null and empty texts have no words: nothing is hit, and such an item is in no document. Items that
share an id are one item; a null item id counts as an empty text. Rows of documents that repeat are
treated each, null ids too. No benchmark: nothing is hit. Columns of documents other than ``doc_id``
and ``text``, and of the benchmark other than ``item_id`` and ``text``, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, stored
from tidemark.llm.shingles import joined, mix, word_hashes

_BITS = 24
_BYTES = 1_000_000
# bytes in no word: all of ASCII but digits and letters
_GAP = np.ones(256, bool)
_GAP[128:] = False
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
# of the hashes of grams, and of the two hashes of windows and texts
_GRAM, _FACTORS = 0xD6E8FEB86659FD93, (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def _rolled(words: np.ndarray, size: int, factor: int) -> np.ndarray:
    """A hash of each stretch of so many words."""
    n = len(words) - size + 1
    out = np.zeros(max(0, n), np.uint64)
    for i in range(size if n > 0 else 0):
        out = out * np.uint64(factor) + words[i : i + n]
    return mix(out)


def winnowed(words: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``span`` words the place of its chosen gram, and the hashes of all grams."""
    k = (span + 1) // 2
    grams = _rolled(words, k, _GRAM)
    n = max(0, len(words) - span + 1)
    chosen, least = np.arange(n), grams[:n].copy()
    for i in range(1, span - k + 1):
        next_ = grams[i : i + n]
        lower = next_ < least
        chosen[lower] = np.flatnonzero(lower) + i
        least[lower] = next_[lower]
    return chosen, grams


def _texts(batch: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """So many texts at a time: the number of the first, their words' hashes, where each text's words start."""
    start, texts, size = 0, [], 0
    for at, text in enumerate(batch):
        texts.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(texts[-1])
        if size >= _BYTES or at == len(batch) - 1:
            yield start, *word_hashes(*joined(texts), _GAP)
            start, texts, size = at + 1, [], 0


def _windows(words: np.ndarray, first: np.ndarray, span: int, known: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Place, fingerprint and two hashes of each window that lies in one text and may be known."""
    chosen, grams = winnowed(words, span)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = text[: len(chosen)] == text[span - 1 :]
    if known is not None:
        slot = grams >> np.uint64(64 - _BITS)
        maybe = (known[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)
        inside &= maybe[chosen].astype(bool)
    at = np.flatnonzero(inside)
    both = []
    for factor in _FACTORS:  # of these windows only, as few are left
        out = np.zeros(len(at), np.uint64)
        for i in range(span):
            out = out * np.uint64(factor) + words[at + i]
        both.append(mix(out).view(np.int64))
    return at, grams[chosen[at]].view(np.int64), *both


def item_windows(benchmark: DataFrame, span: int) -> DataFrame:
    """item, span, gram, a, b: the windows of all items, each once."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            item = batch["item"].to_numpy()
            for start, words, first in _texts(batch["text"]):
                sizes = np.diff(first)
                for size in np.unique(np.minimum(sizes, span)).tolist():
                    own = np.flatnonzero(np.minimum(sizes, span) == size) if size else []
                    for i in own:
                        _, gram, a, b = _windows(words[first[i] : first[i + 1]], np.array([0, sizes[i]]), size)
                        yield pd.DataFrame({"item": item[start + i], "span": size, "gram": gram, "a": a, "b": b})

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return rows.mapInPandas(read, "item string, span int, gram bigint, a bigint, b bigint").distinct()


def known_grams(windows: DataFrame) -> tuple[list[int], np.ndarray]:
    """The spans that occur, and the table of bits that fingerprints set; both of bounded size."""
    spans = sorted(r["span"] for r in windows.select("span").distinct().collect())
    slot = F.shiftrightunsigned("gram", 64 - _BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(gram, {64 - _BITS}) & 63 as int))")
    rows = windows.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
    table = np.zeros(1 << (_BITS - 6), np.int64)
    table[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return spans, table.view(np.uint64)


def scanned(documents: DataFrame, spans: list[int], table: np.ndarray) -> DataFrame:
    """doc_id, n_words, and of each document with windows that may be known: two hashes of its words, and these windows."""
    shared = documents.sparkSession.sparkContext.broadcast(table)
    arrays = ("span", "at", "gram", "a", "b")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, words, first in _texts(batch["text"]):
                n = len(first) - 1
                found = [[] for _ in range(n)]
                for span in spans:
                    at, *rest = _windows(words, first, span, shared.value)
                    owner = np.searchsorted(first, at, side="right") - 1
                    cuts = np.searchsorted(owner, np.arange(1, n))
                    columns = (np.full(len(at), span, np.int32), at - first[owner], *rest)
                    parts = [np.split(x, cuts) for x in columns] if len(at) else []
                    for i in np.unique(owner).tolist():
                        found[i].append([x[i] for x in parts])
                out = {"doc_id": batch["doc_id"].iloc[start : start + n].to_numpy(), "n_words": np.diff(first)}
                out |= {x: [_marks(words[first[i] : first[i + 1]])[k] if w else None for i, w in enumerate(found)] for k, x in enumerate("xy")}
                for k, column in enumerate(arrays):
                    out[f"w_{column}"] = [np.concatenate([part[k] for part in w]) if w else None for w in found]
                yield pd.DataFrame(out).astype({"doc_id": "Int64", "x": "Int64", "y": "Int64"})

    kind = "doc_id bigint, n_words bigint, x bigint, y bigint, w_span array<int>, w_at array<bigint>, "
    kind += "w_gram array<bigint>, w_a array<bigint>, w_b array<bigint>"
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(scan, kind)


def _marks(words: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole sequence of words."""
    at = np.arange(1, len(words) + 1, dtype=np.uint64)
    both = [mix(words + at * np.uint64(f)).sum(dtype=np.uint64) for f in _FACTORS]
    return tuple(np.array(both, np.uint64).view(np.int64).tolist())


def contamination(documents: DataFrame, benchmark: DataFrame, folder: str, span: int = 10) -> DataFrame:
    """For each document: doc_id, n_words, n_hit, and items, the ids in the order of texts.

    A document's items are as many as its own windows allow; they are one array.
    """
    spark = documents.sparkSession
    windows = stored(item_windows(benchmark, span), f"{folder}/windows")
    rows = stored(scanned(documents, *known_grams(windows)), f"{folder}/scanned")
    some = rows.where("x is not null")
    texts = some.groupBy("x", "y").agg(F.first(F.arrays_zip("w_span", "w_at", "w_gram", "w_a", "w_b")).alias("w"))
    own = texts.select("x", "y", F.explode("w").alias("w")).select("x", "y", *[F.col(f"w.w_{c}").alias(c) for c in ("span", "at", "gram", "a", "b")])
    own = stored(own, f"{folder}/own")
    keys = ["span", "gram", "a", "b"]
    found = stored(own.join(windows.select(*keys).distinct(), keys), f"{folder}/found")

    before = Window.partitionBy("x", "y").orderBy("at", "span").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("span")
    new = end - F.greatest("at", F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = found.select("x", "y", F.greatest(new, F.lit(0)).alias("new")).groupBy("x", "y").agg(F.sum("new").alias("n_hit"))
    met = found.select("x", "y", *keys).distinct().join(windows, keys).select("x", "y", "item").distinct()
    items = met.groupBy("x", "y").agg(F.sort_array(F.collect_list("item")).alias("items"))
    facts = stored(hit.join(items, ["x", "y"]), f"{folder}/facts")
    for step in ("own", "found"):
        dropped(spark, f"{folder}/{step}")
    nothing = F.array().cast("array<string>")
    hits = some.select("doc_id", "n_words", "x", "y").join(facts, ["x", "y"], "left")
    hits = hits.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("items", nothing).alias("items"))
    clean = rows.where("x is null").select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_hit"), nothing.alias("items"))
    return hits.unionByName(clean)
