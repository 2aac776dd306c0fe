"""Line dedup by pairwise alignment.

Documents become arrays of line hashes; texts are not moved. Each line hash that several
documents have names its first holder, the document with the smallest id, as a partner of each
later document with that line, however many they are (``rare`` bounds nothing and is still taken
for older callers). A line nominates one holder however many documents share it: the pairs grow
with the lines, not with the square of a group.

With ``further``, a shared line that a document still has then names its other earlier holders. What
aligns depends on the shared and blank lines of both documents only, in their order and with a mark
where others stand between them. So documents with the same such skeleton are one class: a line names
classes of holders, in rounds of 3, 12, 48 ... of them, until each was tried, and a pair of classes
is aligned once, however many documents they have. A document loses what its class loses to classes
that began before it: the result is that of all pairs of documents. Copies of a template with texts of their own are one class.

Each pair is aligned by patience diff: lines that are unique in both are anchors, the longest
chain of them in order stands, and the gaps between are aligned in the same way; a gap without
anchors keeps its equal head and tail. Aligned runs of lines are deleted from the later document,
blank-only runs are not. A document's deletions from all its pairs are united.

The first holder of a line never loses it, so no line disappears from the corpus. Documents that
share an id are ordered by a hash of the text; rows repeated in full are one document, and each of
them keeps what that one keeps. A null text has no lines and stays null; an empty text has one
blank line. Null ids come last. Other columns are kept as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, ranked, stored


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal items, rising in both lists."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {b[y]: y for y in range(k, m) if in_b[b[y]] == 1}
        both = [(x, place[a[x]]) for x in range(i, j) if in_a[a[x]] == 1 and a[x] in place]
        chain = _rising(both)
        if not chain:
            continue
        p, q = i, k
        for x, y in chain:
            todo.append((p, x, q, y))
            out.append((x, y))
            p, q = x + 1, y + 1
        todo.append((p, j, q, m))
    return sorted(out)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs whose second places rise; the first places rise already."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, y) in enumerate(pairs):
        at = bisect_left(ends, y)
        before.append(last[at - 1] if at else -1)
        if at == len(ends):
            ends.append(y)
            last.append(n)
        else:
            ends[at], last[at] = y, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def line_hashes(text: str = "text") -> Column:
    """A hash for each line; blank lines are 0."""
    lines = F.split(F.col(text), "\n")
    return F.transform(lines, lambda x: F.when(F.trim(x) == "", F.lit(0).cast("bigint")).otherwise(F.xxhash64(x)))


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for earlier, later in zip(batch["earlier"], batch["later"], strict=True):
            found.append([x for x, _ in _solid(patience(later.tolist(), earlier.tolist()), later)])
        yield pd.DataFrame({"place": batch["place"], "gone": found})


def _solid(pairs: list[tuple[int, int]], lines: np.ndarray) -> list[tuple[int, int]]:
    """The pairs in unbroken runs that hold a line that is not blank."""
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []
    for pair in pairs:
        if run and (pair[0] != run[-1][0] + 1 or pair[1] != run[-1][1] + 1):
            out += run if any(lines[x] for x, _ in run) else []
            run = []
        run.append(pair)
    return out + (run if any(lines[x] for x, _ in run) else [])


def _pair_deletions(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The places of lines that each pair (place, first) aligns, by the later document."""
    pairs = pairs.join(texts.select("place", F.col("lines").alias("later")), "place")
    pairs = pairs.join(texts.select(F.col("place").alias("first"), F.col("lines").alias("earlier")), "first")
    kind = texts.schema["place"].dataType.simpleString()
    return pairs.select("place", "earlier", "later").mapInPandas(_aligned, f"place {kind}, gone array<int>")


def _united(gone: DataFrame) -> DataFrame:
    gone = gone.where(F.size("gone") > 0).groupBy("place")
    return gone.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def _lines_left(texts: DataFrame) -> DataFrame:
    """The different lines that are not blank and not gone: place, line."""
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    left = F.array_distinct(F.transform(stay, lambda i: F.get("lines", i)))
    return texts.select("place", F.explode(left).alias("line")).where("line <> 0")


_OTHER = 1  # in a skeleton, lines that no other document has


def _skeletons(once: DataFrame, holders: DataFrame, shared: DataFrame) -> DataFrame:
    """place, skeleton and at (where each of its lines stands in the document) of the documents that hold some lines."""
    flat = once.join(holders.select("place").distinct(), "place").select("place", F.posexplode("lines").alias("pos", "line"))
    flat = flat.join(shared.select("line", F.lit(True).alias("known")), "line", "left")
    mark = F.when((F.col("line") == 0) | F.col("known"), F.col("line")).otherwise(F.lit(_OTHER))
    rows = flat.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("pos", mark.alias("mark")))).alias("all"))
    other = lambda x: x["mark"] == _OTHER
    rows = rows.withColumn("all", F.filter("all", lambda x, i: ~(other(x) & F.coalesce(other(F.get("all", i - 1)), F.lit(False)))))
    return rows.select("place", F.transform("all", lambda x: x["mark"]).alias("skeleton"), F.transform("all", lambda x: x["pos"]).alias("at"))


def _aligned_classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for earlier, later in zip(batch["earlier"], batch["later"], strict=True):
            earlier = np.where(earlier == _OTHER, 2, earlier)  # what others have is like nothing else
            found.append([x for x, _ in _solid(patience(later.tolist(), earlier.tolist()), later)])
        yield pd.DataFrame({"cls": batch["cls"], "first": batch["first"], "gone": found})


def _further(once: DataFrame, line: DataFrame, shared: DataFrame, gone: DataFrame, folder: str) -> DataFrame:
    """``gone`` with what aligns with other earlier holders than the first."""
    spark = once.sparkSession
    left = _lines_left(once.join(gone, "place", "left")).join(shared, "line").where("place > first")
    left = stored(left.select("place", "line"), f"{folder}/left")
    holders = stored(line.join(left.select("line").distinct(), "line"), f"{folder}/holders")
    members = stored(_skeletons(once, holders, shared).withColumn("cls", F.xxhash64("skeleton")), f"{folder}/members")
    classes = members.groupBy("cls").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.first("skeleton").alias("skeleton"))
    classes = stored(classes, f"{folder}/classes")
    of = members.select("place", "cls")
    lists = holders.join(of, "place").select("line", "cls").distinct().join(classes.select("cls", "first"), "cls")
    lists = stored(ranked(lists, ["line", "first"], f"{folder}/lists"), f"{folder}/ranked")
    begin = stored(lists.groupBy("line").agg(F.min("rank").alias("begin"), F.max("rank").alias("end")), f"{folder}/begin")
    lists = lists.join(begin, "line").select("line", "cls", "first", (F.col("rank") - F.col("begin")).alias("nth"))
    lists = stored(lists, f"{folder}/nth")
    todo = left.join(of, "place").select("line", "cls").distinct().join(classes.select("cls", F.col("last").alias("stop")), "cls")
    todo = todo.join(begin.select("line", (F.col("end") - F.col("begin")).alias("most")), "line")
    kind = classes.schema["first"].dataType.simpleString()
    low, since = 1, None
    while True:  # the first holder was tried; its class is number 0
        todo = stored(todo.where(F.col("most") >= low), f"{folder}/todo-{low}")
        if todo.isEmpty():
            break
        named = lists.where(F.col("nth").between(low, 4 * low - 1)).select("line", F.col("cls").alias("holder"), "first")
        pairs = todo.join(named, "line").where("first < stop").select("cls", "holder", "first").distinct()
        pairs = stored(pairs, f"{folder}/pairs-{low}")
        both = pairs.join(classes.select("cls", F.col("skeleton").alias("later")), "cls")
        both = both.join(classes.select(F.col("cls").alias("holder"), F.col("skeleton").alias("earlier")), "holder")
        new = both.select("cls", "first", "earlier", "later").mapInPandas(_aligned_classes, f"cls bigint, first {kind}, gone array<int>")
        new = new.select("cls", "first", F.explode("gone").alias("i"))
        new = new if since is None else new.unionByName(since.select("cls", F.col("since").alias("first"), "i"))
        since = stored(new.groupBy("cls", "i").agg(F.min("first").alias("since")), f"{folder}/since-{low}")
        # a line goes on asking up to the class that its last place was lost to
        places = classes.select("cls", "last", F.posexplode("skeleton").alias("i", "line")).join(since, ["cls", "i"], "left")
        stop = places.groupBy("cls", "line").agg(F.max(F.coalesce("since", "last")).alias("stop"))
        low *= 4
        todo = todo.drop("stop").join(stop, ["cls", "line"])
    if since is None:
        return gone
    lost = since.groupBy("cls").agg(F.collect_list(F.struct("i", "since")).alias("lost"))
    more = members.join(lost, "cls").select("place", "at", F.filter("lost", lambda x: x["since"] < F.col("place")).alias("lost"))
    more = more.select("place", F.transform("lost", lambda x: F.get("at", x["i"])).alias("gone"))
    out = stored(_united(gone.unionByName(more)), f"{folder}/all")
    for step in ("left", "holders", "members", "classes", "lists", "ranked", "begin", "nth"):
        dropped(spark, f"{folder}/{step}")
    return out


def deletions(documents: DataFrame, folder: str, rare: int = 100, further: bool = False) -> DataFrame:
    """For each document that loses lines: doc_id, _text (a hash), gone (the places of lines, from 0)."""
    known = documents.select("doc_id", "text").select("doc_id", F.xxhash64("text").alias("_text"), line_hashes().alias("lines"))
    known = known.where("lines is not null")
    # the order of documents, and their names while aligning
    once = known.groupBy("doc_id", "_text").agg(F.first("lines").alias("lines"))
    once = stored(once.withColumn("place", F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_text")), f"{folder}/lines")
    line = once.select("place", F.explode(F.array_distinct("lines")).alias("line")).where("line <> 0")
    shared = line.groupBy("line").agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1").drop("n")
    # stored, so that the join deals both sides anew and Spark can split the rows of a frequent line
    shared = stored(shared, f"{folder}/shared")
    pairs = line.join(shared, "line").where("place > first").select("place", "first").distinct()
    gone = _united(_pair_deletions(pairs, once))
    if further:
        gone = _further(once, line, shared, stored(gone, f"{folder}/first"), f"{folder}/further")
    return gone.select("place.doc_id", "place._text", "gone")


def without_lines(documents: DataFrame, folder: str, rare: int = 100, further: bool = False) -> DataFrame:
    """The documents with _n_lines, _n_removed and _kept, the text that is left (null: none is).

    Columns of these three names are replaced.
    """
    gone = stored(deletions(documents, folder, rare, further), f"{folder}/gone")
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), F.col("gone").alias("_gone"))
    added = ("_n_lines", "_n_removed", "_kept")
    given = [c for c in documents.columns if c not in added]
    # packed, so that no name of theirs meets one of those used here
    rows = documents.select("doc_id", "text", F.struct(*given).alias("_given")).withColumn("_hash_own", F.xxhash64("text"))
    met = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash_own") == F.col("_hash"))
    rows = rows.join(gone, met, "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    left = F.transform(stay, lambda i: F.get(lines, i))
    kept = F.when(F.col("_gone").isNull(), F.col("text")).when(F.size(left) > 0, F.array_join(left, "\n"))
    return rows.select(
        *[F.col("_given")[c].alias(c) for c in given],
        F.coalesce(F.size(lines), F.lit(0)).alias("_n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).alias("_n_removed"),
        kept.alias("_kept"),
    )
