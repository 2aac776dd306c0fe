"""Activity of files kept up to date: each call reads only the files that came since the last one.

A state folder holds two tables: the ledger of files seen (path, time, length), and the latest time per
table, project and mark. The latest time is a maximum, so the state merges with that of new files alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.activity import listed_files, table_activity
from tidemark.sources.schemas import ACTIVITY, conform
from tidemark.sources.staging import read_table, replace_table
from tidemark.sources.versions import current

_SEEN = ["path", "storage_last_modified_time", "bytes"]
_LEDGER = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("storage_last_modified_time", T.TimestampType()), T.StructField("bytes", T.LongType())]
)


def _kept(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """What a table of the state holds; no rows before the first call."""
    if current(spark, target) == target:
        return spark.createDataFrame([], schema)
    return read_table(spark, target)


def unseen_files(spark: SparkSession, paths: Iterable[str], state: str) -> DataFrame:
    """Files that are not in the ledger, or have another time or length than there."""
    listed = listed_files(spark, paths).select(*_SEEN)
    return listed.join(_kept(spark, f"{state}/files", _LEDGER), _SEEN, "left_anti")


def _latest(activity: DataFrame) -> DataFrame:
    return table_activity(activity, *(F.col(name) for name in ("source_project_id", "table_schema", "table_name", "storage_last_modified_time", "deleted")))


def activity_state(spark: SparkSession, state: str) -> DataFrame:
    """The activity of all files seen so far."""
    return _kept(spark, f"{state}/activity", ACTIVITY)


def fold_new_files(spark: SparkSession, paths: Iterable[str], state: str, activity: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Reads the Parquet files that are not in the ledger, folds them into the state and returns the activity.

    ``activity`` turns rows of the files into rows with the columns of activity. A file that was changed is
    read again; what it said before stays, as does the activity of files that are gone. The state is
    replaced before the ledger: a call that stops in between is made up for by the next one, which folds
    the same files once more, with the same result. The driver holds the names of new files, as Spark's own listing does.
    """
    new = unseen_files(spark, paths, state).collect()
    if new:
        rows = conform(activity(spark.read.parquet(*(r["path"] for r in new))), ACTIVITY)
        replace_table(_latest(activity_state(spark, state).unionByName(_latest(rows))), f"{state}/activity")
        seen = spark.createDataFrame(new, _LEDGER)
        before = _kept(spark, f"{state}/files", _LEDGER).join(seen.select("path"), "path", "left_anti")
        replace_table(before.select(*_SEEN).unionByName(seen), f"{state}/files")
    return activity_state(spark, state)
