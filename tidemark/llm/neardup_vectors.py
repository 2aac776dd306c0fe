"""Near copies among vectors: sorted projection passes.

Each pass hashes every vector to the signs of its products with random directions, drawn from a
fixed seed, and sorts all vectors by that string of bits and then by id. Vectors that are nearly
parallel share long prefixes with good chance; every pass uses other directions. A few passes at a
time run as one sort, which is deleted when its pairs are found, so that the vectors are held so many times and not once for each pass. The order is cut into blocks of equal size, each with the first ``window`` rows of the
next block, so no pair of close neighbours is lost at a cut and a third of all vectors with one hash
are still many blocks. All vectors of a block are compared with each other: in a dense group, whose
members the bits hardly tell apart, a pair need not be close in the order but in one block. Beyond
65,536 vectors the passes grow with the square root of their number, as blocks hold a smaller part
of such a group then. The search stays one by chance: a pair that no pass brings into one block is
missed.

Pairs are verified in double precision where they are found. A block hands on a spanning forest of
its verified pairs, and the forests of all passes are united to components. A vector's links are
then counted exactly among the members of its component, block by block: no pair of a component is
emitted, and none depends on a window. Counting is quadratic in a component's distinct vectors, as
the exact number of links of each is asked for.

Equal vectors are one vector while searching; copies count as links of each other. Null, empty or
zero vectors and those with null or non-finite components link with nothing. Vectors of different
lengths do not link. Rows that repeat an id: each row is a vector, and the id's links are those of
the row with most; they stay one row of the result each.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, dropped, ranked, stored
from tidemark.llm.topk import sound_vectors

_SEED = 20_240_501
#: Distinct vectors from which on the passes grow.
_PASSES_GROW = 65_536


def _keys(vectors: DataFrame, turn: int, passes: int, bits: int) -> DataFrame:
    """The vectors once for each pass of a turn, with the pass and its hash."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drawn: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, rows in batch.groupby(batch["v"].map(len), sort=False):
                if size not in drawn:
                    drawn[size] = np.random.default_rng([_SEED, turn]).standard_normal((size, passes * bits))
                signs = np.stack(rows["v"].to_numpy()).astype(np.float64) @ drawn[size] > 0
                for p in range(passes):
                    packed = np.packbits(signs[:, p * bits : (p + 1) * bits], axis=1)
                    keys = [size.to_bytes(4, "big") + x.tobytes() for x in packed]
                    yield pd.DataFrame({"pass": p, "key": keys, "rep": rows["rep"], "v": rows["v"]})

    kind = vectors.schema["v"].dataType.simpleString()
    return vectors.select("rep", "v").mapInPandas(hashed, f"pass int, key binary, rep bigint, v {kind}")


def _units(vectors: pd.Series) -> np.ndarray:
    rows = np.stack(vectors.to_numpy()).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _forest(least: float):
    """Verified pairs of one block, thinned to a forest."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank", ignore_index=True)
        ids, sizes = block["rep"].to_numpy(), block["v"].map(len).to_numpy()
        edges = [np.empty((0, 2), np.int64)]
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            unit = _units(block["v"].iloc[at])
            # single precision finds those with any neighbour, double precision decides
            rough = unit.astype(np.float32)
            some = np.flatnonzero((rough @ rough.T >= least - 1e-3).sum(axis=1) > 1)
            at, unit = at[some], unit[some]
            near = unit @ unit.T >= least
            # a forest of the verified pairs themselves: each tree edge is a pair that was compared
            fresh = np.ones(len(at), bool)
            for root in range(len(at)):
                todo = [root] if fresh[root] else []
                fresh[root] = False
                while todo:
                    x = todo.pop()
                    met = np.flatnonzero(near[x] & fresh)
                    fresh[met] = False
                    todo += met.tolist()
                    edges.append(np.stack([np.full(len(met), ids[at[x]]), ids[at[met]]], axis=1))
        return pd.DataFrame(np.concatenate(edges), columns=["a", "b"]).astype("int64")

    return run


def _counted(least: float):
    """For each vector of a pair of chunks, the weight of those of the other that it links with."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["chunk"] == group["low"]], group[group["chunk"] == group["high"]]
        alone = bool((group["low"] == group["high"]).iloc[0])
        near = _units(left["v"]) @ _units(right["v"]).T >= least
        out = [pd.DataFrame({"rep": left["rep"], "links": near @ right["copies"].to_numpy()})]
        if not alone:
            out.append(pd.DataFrame({"rep": right["rep"], "links": left["copies"].to_numpy() @ near}))
        return pd.concat(out).astype("int64")

    return run


def near_vectors(
    vectors: DataFrame,
    folder: str,
    least: float = 0.95,
    passes: int = 24,
    bits: int = 64,
    window: int = 24,
    block: int = 2048,
    chunk: int = 512,
    at_once: int = 6,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = sound_vectors(vectors).where(norm > 0).select("vec_id", "v", F.xxhash64("v").alias("h"), F.hash("v").alias("g"))
    # copies: equal arrays, grouped by the array itself
    reps = stored(
        rows.groupBy("h", "g", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        f"{folder}/reps",
    )
    members = rows.join(reps.select("h", "g", F.col("v").alias("w"), "rep", "copies"), ["h", "g"])
    members = stored(members.where("v = w").select("vec_id", "rep", "copies"), f"{folder}/members")

    passes = ceil(passes * max(1.0, (reps.count() / _PASSES_GROW) ** 0.5))
    spark = vectors.sparkSession
    turns = range(0, passes, at_once)
    for turn in turns:
        some = min(at_once, passes - turn)
        order = ranked(_keys(reps, turn, some, bits), ["pass", "key", "rep"], f"{folder}/order-{turn}")
        at = (F.col("rank") / block).cast("bigint")
        halo = F.when((F.col("rank") % block < window) & (at > 0), F.array(at, at - 1)).otherwise(F.array(at))
        blocks = order.withColumn("block", F.explode(halo)).groupBy("pass", "block")
        stored(blocks.applyInPandas(_forest(least), "a bigint, b bigint").distinct(), f"{folder}/edges-{turn}")
        dropped(spark, f"{folder}/order-{turn}")
    edges = spark.read.schema("a bigint, b bigint").parquet(*(f"{folder}/edges-{turn}" for turn in turns))
    comps = stored(components(edges, f"{folder}/components"), f"{folder}/labels")

    inside = reps.select("rep", "v", "copies").join(comps, F.col("rep") == F.col("node")).drop("node")
    inside = ranked(inside, ["component", "rep"], f"{folder}/inside")
    first = inside.groupBy("component").agg(F.min("rank").alias("first"), F.count("*").alias("size"))
    # stored, so that the join deals both sides anew and Spark can split a large component
    first = stored(first, f"{folder}/first")
    parts = inside.join(first, "component").withColumn("chunk", ((F.col("rank") - F.col("first")) / chunk).cast("int"))
    other = F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / chunk).cast("int")))
    pairs = parts.withColumn("other", other).select(
        "component", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "*"
    )
    columns = ["component", "low", "high", "chunk", "rep", "copies", "v"]
    pairs = pairs.select(inside["component"], *columns[1:])
    counts = pairs.groupBy("component", "low", "high").applyInPandas(_counted(least), "rep bigint, links bigint")
    counts = stored(counts.groupBy("rep").agg(F.sum("links").alias("links")), f"{folder}/counts")
    for step in ("reps", "inside", "first", *(f"edges-{turn}" for turn in turns)):
        dropped(spark, f"{folder}/{step}")

    linked = (
        members.join(counts, "rep", "left")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "vec_id",
            (F.coalesce("links", "copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    every = vectors.select("vec_id").withColumn("_n", F.lit(1)).groupBy("vec_id").agg(F.count("*").alias("_n"))
    best = linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = every.join(best, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))).alias("_row"),
    )
    return out.drop("_row").withColumn("kept", F.col("vec_id") == F.col("component_id"))
