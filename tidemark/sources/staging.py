"""Tables that one step writes and a later one reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrichment import report_order
from tidemark.sources.activity import union_frames
from tidemark.sources.versions import commit, new_version, read_current, written


def _is_path(target: str) -> bool:
    return "/" in target


def replace_table(df: DataFrame, target: str) -> int:
    """Replace a table (a name) or a folder (a path) with these rows; returns how many there are.

    A folder gets a new version, so readers see the old rows or the new ones, and a write that fails
    leaves the old ones. So does a table that exists with the same columns: it is pointed to the new
    version. An empty frame leaves a table without rows that still has its columns.
    """
    spark = df.sparkSession
    folder = target if _is_path(target) else _table_folder(spark, target)
    version = new_version(spark, folder)
    rows = written(df, version)
    commit(spark, version)
    if not _is_path(target):
        _point(spark, target, version)
    return rows


def _table_folder(spark: SparkSession, name: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions"


def _point(spark: SparkSession, name: str, version: str) -> None:
    """Makes a table of the catalog show a version."""
    if spark.catalog.tableExists(name):
        if spark.table(name).schema == spark.read.parquet(version).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")  # other columns: there is no such table for a moment
    spark.catalog.createTable(name, version, "parquet")


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """What ``replace_table`` wrote."""
    return read_current(spark, target) if _is_path(target) else spark.table(target)


def read_violations(spark: SparkSession, target: str) -> DataFrame:
    """The stored violations in report order, which a table does not keep."""
    return read_table(spark, target).orderBy(*report_order())


def row_counts(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each input. For a stored table Spark reads file footers only."""
    return union_frames(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("input"), "row_count")
        for name, df in inputs.items()
    )
