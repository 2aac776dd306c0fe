"""Shared folders, stored steps, ranks and connected components for the operators here."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_held: dict = {}


def held(key, make):
    """An object kept by a worker process for its next tasks; only the last one asked for stays."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name under the checkpoint folder of the session, which all executors share.

    Only a session on one machine may lack that setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        known = context._jsc.sc().getCheckpointDir()
        if known.isDefined():
            base = known.get()
        elif context.master.startswith("local[") or context.master == "local":
            base = tempfile.mkdtemp(prefix="tidemark-")
            context.setCheckpointDir(base)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(frame: DataFrame, path: str) -> DataFrame:
    """The frame, written to a shared folder and read back: what follows repeats none of its work."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """What is stored within it hands its rows to Python at most so many at a time, which both sides then hold.

    Spark's own number of rows says nothing of their size: whole texts and sets are large.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(rows if before <= 0 else min(rows, before)))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a folder of one's own that is read no more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions(spark: SparkSession) -> int:
    """How many parts a shuffle has in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(frame: DataFrame, order: list[Column | str], path: str, name: str = "rank") -> DataFrame:
    """The frame with each row's place in a global order, from 0.

    Rows are range-sorted and stored with their place within the part; the sizes of the parts,
    one row for each part, give what to add.
    """
    spark = frame.sparkSession
    placed = (
        frame.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    rows = stored(placed, path).withColumn("_part", F.shiftright("_place", 33))
    sizes = sorted(rows.groupBy("_part").count().collect())
    base, before = [], 0
    for part, size in sizes:
        base.append((part, before))
        before += size
    bases = spark.createDataFrame(base, "_part bigint, _before bigint")
    return (
        rows.join(F.broadcast(bases), "_part")
        .withColumn(name, F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before"))
        .drop("_part", "_place", "_before")
    )


def components(edges: DataFrame, path: str) -> DataFrame:
    """For each node of an edge list (a, b): the smallest node it is connected with.

    Large-star and small-star steps take turns until the edges stay the same; each step keeps
    or lowers the number of edges and is stored in the shared folder. Columns: node, component.
    """
    spark = edges.sparkSession
    plain = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(plain.distinct(), f"{path}/0")
    print_now = _print(now)
    turn = 0
    while print_now[0]:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # stored, so that the join deals both sides anew and Spark can split the edges of a hub
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), f"{path}/{turn}-least")
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), f"{path}/{turn}-large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), f"{path}/{turn}-lower")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        turn += 1
        after = stored(small.distinct(), f"{path}/{turn}")
        print_after = _print(after)
        for name in ("", "-large", "-least", "-lower"):
            dropped(spark, f"{path}/{turn - 1}{name}")
        now, same = after, print_after == print_now
        print_now = print_after
        if same:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _print(edges: DataFrame) -> tuple:
    """Tells whether two edge lists are the same."""
    hashed = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.sum(hashed.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(hashed, 32))).first()
    return tuple(row)
