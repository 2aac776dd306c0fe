"""Folders that are replaced as a whole: a reader sees the old content or the new, never a part.

Each replacement is written to a folder of its own, ``_v<number>`` within the target, and counts from the
moment a marker file is created in it, which is one atomic step of the file system. Readers take the
highest number that has its marker. A write that fails leaves no marker, so the version before stands.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_VERSION = re.compile(r"_v(\d+)")
_MARKER = "_committed"


def _path(spark: SparkSession, target: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, target: str) -> dict[int, bool]:
    """The versions there are, and whether each counts."""
    path, files = _path(spark, target)
    if not files.exists(path) or files.getFileStatus(path).isFile():
        return {}
    names = [status.getPath().getName() for status in files.listStatus(path)]
    found = sorted(int(m[1]) for m in map(_VERSION.fullmatch, names) if m)
    return {n: files.exists(_path(spark, f"{target}/_v{n}/{_MARKER}")[0]) for n in found}


def current(spark: SparkSession, target: str) -> str:
    """The folder to read: the newest version that counts; without versions the target itself."""
    known = [n for n, counts in _numbers(spark, target).items() if counts]
    return f"{target}/_v{max(known)}" if known else target


def new_version(spark: SparkSession, target: str) -> str:
    """A folder to write to; it counts after ``commit``. Two writers at once: the second one's write fails."""
    return f"{target}/_v{max(_numbers(spark, target), default=0) + 1}"


def commit(spark: SparkSession, version: str) -> None:
    """Makes a written version the current one; keeps the one before for those who read it, removes older ones."""
    path, files = _path(spark, f"{version}/{_MARKER}")
    files.create(path, False).close()
    target, _, own = version.rpartition("/_v")
    known = _numbers(spark, target)
    before = [n for n, counts in known.items() if counts and n < int(own)]
    for n in known:
        if n < int(own) and n != max(before, default=0):
            files.delete(_path(spark, f"{target}/_v{n}")[0], True)


def written(df: DataFrame, version: str) -> int:
    """Writes the rows as Parquet and returns how many there were, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(version)
    return seen.get["n"]


def dropped(spark: SparkSession, version: str) -> None:
    """Removes a version that will not count."""
    path, files = _path(spark, version)
    files.delete(path, True)


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """What the target holds now. A version that goes between the look and the read is looked up again."""
    for _ in range(3):
        try:
            return spark.read.parquet(current(spark, target))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" or not _numbers(spark, target):
                raise
    return spark.read.parquet(current(spark, target))
