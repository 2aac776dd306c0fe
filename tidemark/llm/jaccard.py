"""Exact Jaccard join of word-shingle sets: grouped prefix join.

Documents with equal sets are one class. In the global order of shingles a fixed share of them, those
with the smallest hashes, comes first, from rare to frequent: their counts over all classes are
exact, from a Spark aggregate. The rest follows by hash. That share is chosen so that a set's prefix, which is
so short that two sets that link must share a shingle of their prefixes, rarely needs the rest, so
only the share is ever counted and moved. Shingles of one class only, the rarest, stay in its
prefix as a number. A class with a prefix of nothing else has no partner and is done. Classes
with equal size and equal shared prefix form one group.

Candidates are filtered in blocks, so a large family of near copies never becomes rows for all
its pairs. Classes stand in chunks of at most ``chunk``, those together that share their most
frequent prefix shingle. Chunks meet where classes of theirs share a prefix shingle and their sizes
allow a link; the overlap of the prefixes bounds that of the sets, and chunk pairs without a pair
of groups within the bound are dropped. The others are expanded to classes and verified on the
whole sets, a pair of chunks at a time: each pair of classes is decided in one place, which adds
up the links of each class and hands on a forest of them for the components. What a step stored is
deleted when it is read no more.

A document without words has an empty set and links with nothing. Null text is a text without
words. A null id takes part in nothing. Documents that share an id are told apart by their sets,
but count as one node: what links with one of them is reachable by all. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, dropped, ranked, small_batches, stored
from tidemark.llm.shingles import mix, shingle_sets

# how many times a prefix the counted shingles of a set are, on average
_SLACK = 1.5
_SLOTS = 1 << 20


def prefix_length(n: int, percent: int) -> int:
    """How many of n shingles, in global order, must meet those of any set that links."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _texts(batch: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch]


def counted_below(percent: int) -> int:
    """Shingles below this number are counted; numbers are spread evenly over 64 signed bits."""
    return int(min(1.0, _SLACK * (100 - percent) / 100) * (2**64 - 1)) - 2**63


def _signed(x: np.ndarray) -> np.ndarray:
    """Signed numbers in the same order."""
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def _sums(x: np.ndarray) -> tuple[int, int]:
    """Two sums that tell sets apart, whatever their order."""
    both = np.array([x.sum(dtype=np.uint64), mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64)
    return tuple(both.view(np.int64).tolist())


def signatures(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, two hashes of the set, its counted shingles and what else its prefix needs, and how many are counted."""
    below = counted_below(percent)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, own in zip(batch["doc_id"], shingle_sets(_texts(batch["text"]), width), strict=True):
                rising = _signed(own)
                counted = int(np.searchsorted(rising, below))
                pool = rising[: max(counted, prefix_length(len(own), percent))].copy()  # the rest of the set goes
                out.append((doc, len(own), *_sums(own), counted, pool))
            frame = pd.DataFrame(out, columns=["doc_id", "n", "a", "b", "counted", "pool"])
            yield frame.astype({"doc_id": "Int64"})

    kind = "doc_id bigint, n bigint, a bigint, b bigint, counted bigint, pool array<bigint>"
    return documents.select("doc_id", "text").mapInPandas(sign, kind)


def with_prefixes(classes: DataFrame, percent: int, folder: str) -> DataFrame:
    """Classes whose prefix has shingles of other classes too: these, how frequent the most frequent one is, and the prefix's end.

    Of the prefix's places the shingles that no other class has take the first. (end, end_hash) is the
    place in the global order of its last shingle.
    """
    posting = classes.select("set", F.explode("pool").alias("v"))
    # stored, so that the join deals both sides anew and Spark can split the rows of a frequent shingle
    often = posting.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    often = stored(often, f"{folder}/often")
    met = posting.join(often, "v").groupBy("set").agg(F.collect_list(F.struct("c", "v")).alias("met"))
    met = stored(met, f"{folder}/met")
    below = F.lit(counted_below(percent)).cast("bigint")
    first = F.sort_array(F.filter("met", lambda x: x["v"] < below))
    length = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    rows = classes.join(met, "set").withColumns({"first": first, "beyond": F.filter("met", lambda x: x["v"] >= below)})
    room = F.greatest(length - (F.col("counted") - F.size("first")), F.lit(0)).cast("int")
    rows = rows.withColumn("first", F.slice("first", F.lit(1), room))
    rows = rows.withColumn("head", F.concat("first", "beyond")).where(F.size("head") > 0)
    whole = F.size("pool") > F.col("counted")
    return rows.select(
        *["set", "n", "class", "a", "b", "copies"],
        F.transform("head", lambda x: x["v"]).alias("head"),
        F.array_max("head").alias("home"),
        F.when(whole, F.lit(1 << 62)).otherwise(F.element_at("first", -1)["c"]).alias("end"),
        F.when(whole, F.element_at("pool", -1)).otherwise(F.element_at("first", -1)["v"]).alias("end_hash"),
    )


def _sets_of(documents: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The wanted classes (class: the id of a document, a, b: of its set) with their whole sets."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sets = shingle_sets(_texts(rows["text"]), width)
            own = [_sums(x)[0] == a for x, a in zip(sets, rows["a"], strict=True)]
            out = rows.assign(set=[_signed(x).tobytes() for x in sets])[own]
            yield out[["class", "a", "b", "cid", "copies", "set"]]

    # texts move only where their id shares a slot with a wanted one; there are _SLOTS of them at most
    slot = F.xxhash64("doc_id").bitwiseAND(F.lit(_SLOTS - 1)).alias("slot")
    slots = wanted.select(F.col("class").alias("doc_id")).select(slot).distinct()
    some = documents.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    rows = some.join(wanted, F.col("doc_id") == F.col("class"))
    rows = rows.select("class", "a", "b", "cid", "copies", "text")
    return rows.mapInPandas(read, "class bigint, a bigint, b bigint, cid bigint, copies bigint, set binary")


def _enough(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection with which sets of these sizes link."""
    return -(-percent * (n + m) // (100 + percent))


def _few_missing(percent: int) -> Column:
    """Whether two chunks share enough prefix shingles for some pair of sizes that they may hold.

    Sets of n >= m elements that link have ceil(p (n + m) / (100 + p)) in common, of which at most
    ceil(p n / 100) - 1 lie beyond a prefix. That falls with n and rises with m, so the largest n
    and the smallest m, which is no less than p n / 100, need least.
    """
    n = F.greatest("low_most", "high_most")
    m = F.least("low_least", "high_least")
    common = F.ceil(percent * (n + F.greatest(m, F.ceil(percent * n / 100))) / (100 + percent))
    # one more than needed is let through, for the division
    return F.col("shared") >= common - F.ceil(percent * n / 100)


def _promising(percent: int):
    """Of pairs of chunks, those in which the prefixes of some pair of groups overlap enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for r in batch.itertuples(index=False):
                n, m = np.asarray(r.x_n), np.asarray(r.y_n)
                # all of the smaller end's rest may be shared, but nothing of its prefix with the other's rest
                rest_x, rest_y = (-(-percent * sizes // 100) - 1 for sizes in (n, m))
                end_x, end_y = np.asarray(r.x_end)[:, None], np.asarray(r.y_end)
                x_first = end_x < end_y
                x_first |= (end_x == end_y) & (np.asarray(r.x_end_hash)[:, None] <= np.asarray(r.y_end_hash))
                most = _common(list(r.x_head), list(r.y_head)) + np.where(x_first, rest_x[:, None], rest_y)
                near = most >= _enough(n[:, None], m[None, :], percent)
                near &= percent * np.maximum(n[:, None], m) <= 100 * np.minimum(n[:, None], m)
                if r.low == r.high:
                    near &= np.tri(len(n), k=-1, dtype=bool) | np.diag(np.asarray(r.x_members) > 1)
                keep.append(bool(near.any()))
            yield batch.loc[keep, ["low", "high"]]

    return run


def _links(percent: int):
    """Links between the classes of two chunks: their numbers by class, and a forest of them."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["cid"] == group["low"]], group[group["cid"] == group["high"]]
        alone = bool((group["low"] == group["high"]).iloc[0])
        x = [np.frombuffer(s, np.int64) for s in left["set"]]
        y = x if alone else [np.frombuffer(s, np.int64) for s in right["set"]]
        n, m = np.array([len(s) for s in x]), np.array([len(s) for s in y])
        near = _common(x, y) >= _enough(n[:, None], m[None, :], percent)
        if alone:
            near[np.diag_indices(len(near))] = False
        sums = [(left, near @ right["copies"].to_numpy())]
        if not alone:
            sums.append((right, left["copies"].to_numpy() @ near))
        out = [
            pd.DataFrame({"class": side["class"], "a": side["a"], "b": side["b"], "links": links, "to": side["class"]})
            for side, links in sums
        ]
        root: dict = {}

        def top(v):
            while root.setdefault(v, v) != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        names, others = left["class"].to_numpy(), right["class"].to_numpy()
        edges = []
        for i, j in zip(*np.nonzero(near), strict=True):
            s, t = top(names[i]), top(others[j])
            if s != t:
                root[max(s, t)] = min(s, t)
                edges.append((names[i], others[j]))
        if edges:
            e = np.array(edges, np.int64)
            out.append(pd.DataFrame({"class": e[:, 0], "a": 0, "b": 0, "links": 0, "to": e[:, 1]}))
        return pd.concat(out).astype("int64")

    return run


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 columns for the shingles both sides have."""
    rows_x = np.repeat(np.arange(len(x)), [len(s) for s in x])
    rows_y = np.repeat(np.arange(len(y)), [len(s) for s in y])
    flat_x, flat_y = np.concatenate(x), np.concatenate(y)
    known = np.intersect1d(flat_x, flat_y)
    out = np.zeros((len(x), len(y)), np.float32)

    def columns(flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(known, flat)
        ok = at < len(known)
        ok[ok] = known[at[ok]] == flat[ok]
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], rows[ok][order]

    (cx, rx), (cy, ry) = columns(flat_x, rows_x), columns(flat_y, rows_y)
    step = 2048  # so many columns at a time
    for start in range(0, len(known), step):
        parts = []
        for c, r, size in ((cx, rx, len(x)), (cy, ry, len(y))):
            a, b = np.searchsorted(c, [start, start + step])
            part = np.zeros((size, min(step, len(known) - start)), np.float32)
            part[r[a:b], c[a:b] - start] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def jaccard_join(
    documents: DataFrame, folder: str, width: int = 4, percent: int = 85, chunk: int = 512
) -> DataFrame:
    """One row per document: doc_id, n_shingles, n_links (other documents it links with), component_id."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    with small_batches(spark):
        signed = stored(signatures(rows, width, percent), f"{folder}/signed")
    classes = (
        signed.where("n > 0 and doc_id is not null")
        .groupBy("n", "a", "b")
        .agg(
            F.min("doc_id").alias("class"),
            F.count("*").alias("copies"),
            F.first("counted").alias("counted"),
            F.first("pool").alias("pool"),
        )
    )
    classes = stored(classes.withColumn("set", F.xxhash64("n", "a", "b")), f"{folder}/pools")
    signed = stored(signed.select("doc_id", "n", "a", "b"), f"{folder}/sets-of-ids")
    dropped(spark, f"{folder}/signed")
    found = with_prefixes(classes, percent, folder)
    # chunks: classes that share their most frequent prefix shingle, in order, so many at a time
    group = F.xxhash64("n", "head", "end", "end_hash")
    found = ranked(found.withColumn("group", group), ["home", "n", "group", "set"], f"{folder}/home")
    cid = F.xxhash64("home.v", F.floor(F.col("rank") / chunk))
    found = stored(found.withColumn("cid", cid).drop("home", "rank"), f"{folder}/chunks")
    classes = stored(classes.drop("pool", "counted", "set"), f"{folder}/classes")
    for step in ("pools", "often", "met", "home"):
        dropped(spark, f"{folder}/{step}")
    lists = found.select("cid", "n", F.explode("head").alias("v")).groupBy("v", "cid").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    lists = stored(lists, f"{folder}/lists")
    other = lists.select("v", *[F.col(c).alias(f"o_{c}") for c in ("cid", "least", "most")])
    fits = f"{percent} * least <= 100 * o_most and {percent} * o_least <= 100 * most"
    met = lists.join(other, "v").where("cid < o_cid").where(fits)
    met = met.select(F.col("cid").alias("low"), F.col("o_cid").alias("high"))
    # how many prefix shingles two chunks share bounds what two groups of theirs do; most pairs share too few
    met = met.groupBy("low", "high").agg(F.count("*").alias("shared"))
    sizes = found.groupBy("cid").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("members"))
    sizes = stored(sizes, f"{folder}/sizes")
    for side in ("low", "high"):
        met = met.join(sizes.select(F.col("cid").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("least", "most")]), side)
    met = met.where(_few_missing(percent)).select("low", "high")
    alone = sizes.where("members > 1").select(F.col("cid").alias("low"), F.col("cid").alias("high"))
    pairs = stored(met.unionByName(alone), f"{folder}/pairs")

    facts = ("n", "head", "end", "end_hash")
    heads = found.groupBy("cid", "group").agg(F.count("*").alias("members"), *[F.first(c).alias(c) for c in facts])
    heads = heads.groupBy("cid").agg(F.collect_list(F.struct("members", *facts)).alias("g"))
    heads = stored(heads.select("cid", *[F.col(f"g.{c}").alias(c) for c in ("members", *facts)]), f"{folder}/heads")
    x, y = (heads.select(*[F.col(c).alias(f"{side}_{c}") for c in heads.columns]) for side in "xy")
    tried = pairs.join(x, F.col("low") == F.col("x_cid")).join(y, F.col("high") == F.col("y_cid")).drop("x_cid", "y_cid", "y_members")
    with small_batches(spark, 16):  # a row has the prefixes of two chunks
        tried = stored(tried.mapInPandas(_promising(percent), "low bigint, high bigint"), f"{folder}/promising")
    for step in ("lists", "sizes", "pairs", "heads"):
        dropped(spark, f"{folder}/{step}")

    asked = tried.select(F.col("low").alias("cid")).unionByName(tried.select(F.col("high").alias("cid"))).distinct()
    wanted = found.select("class", "a", "b", "cid", "copies").join(asked, "cid")
    wanted = stored(wanted.select("class", "a", "b", "cid", "copies"), f"{folder}/wanted")
    with small_batches(spark):
        sets = stored(_sets_of(rows, wanted, width), f"{folder}/sets")
    sides = tried.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("cid"))
    linked = sides.join(sets, "cid").groupBy("low", "high")
    columns = "class bigint, a bigint, b bigint, links bigint, to bigint"
    linked = stored(linked.applyInPandas(_links(percent), columns), f"{folder}/linked")
    for step in ("chunks", "promising", "wanted", "sets"):
        dropped(spark, f"{folder}/{step}")
    edges = linked.where("class <> to").select(F.col("class").alias("a"), F.col("to").alias("b"))
    # rows of one id with different sets are one node
    comps = stored(components(_with_shared_ids(edges, signed, classes), f"{folder}/components"), f"{folder}/labels")
    counts = linked.where("class = to").groupBy("a", "b").agg(F.sum("links").alias("links"))

    known = classes.join(counts, ["a", "b"], "left").select(
        "n", "a", "b", "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    known = known.join(comps, F.col("class") == F.col("node"), "left").select(
        "n", "a", "b", "n_links", F.coalesce("component", "class").alias("component_id")
    )
    out = signed.select("doc_id", "n", "a", "b").join(known, ["n", "a", "b"], "left")
    named = F.col("doc_id").isNotNull() & F.col("component_id").isNotNull()
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(named, F.col("n_links")).otherwise(F.lit(0)).alias("n_links"),
        F.when(named, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _with_shared_ids(edges: DataFrame, signed: DataFrame, classes: DataFrame) -> DataFrame:
    """The edges, and one from each id that several sets have to the class of each of these sets."""
    rows = signed.where("n > 0 and doc_id is not null").select("doc_id", "n", "a", "b")
    several = rows.groupBy("doc_id").agg(F.min("a").alias("s"), F.max("a").alias("t")).where("s <> t")
    met = rows.join(several.select("doc_id"), "doc_id").join(classes.select("n", "a", "b", "class"), ["n", "a", "b"])
    return edges.unionByName(met.select(F.col("doc_id").alias("a"), F.col("class").alias("b")))
