"""Ignore lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = 16


def ignore_tables(tables: DataFrame, ignored: DataFrame) -> DataFrame:
    """Drop the listed (dataset, table) pairs. Same keys as ``live_tables`` groups by."""
    keys = ["table_schema", "table_name"]
    return tables.join(ignored.select(*keys).distinct(), keys, "left_anti")


def ignore_datasets(tables: DataFrame, ignored: DataFrame) -> DataFrame:
    """Drop all tables of the listed datasets, in whatever project the list names them.

    One dataset may hold a large share of all tables. When the list is too big for
    Spark to broadcast, a plain join would send those to one task and keep them
    there for the window that follows, so the dataset key is spread over several.
    """
    spread = tables.withColumn("_spread", F.pmod(F.xxhash64("table_name"), F.lit(_SPREAD)).cast("int"))
    listed = (
        ignored.select(F.col("schema_name").alias("table_schema"))
        .distinct()
        .withColumn("_spread", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))))
    )
    return spread.join(listed, ["table_schema", "_spread"], "left_anti").select(*tables.columns)


def exclude(
    tables: DataFrame,
    ignored_datasets: DataFrame | None = None,
    ignored_tables: DataFrame | None = None,
) -> DataFrame:
    """Apply both ignore lists; one that is not given excludes nothing."""
    if ignored_tables is not None:
        tables = ignore_tables(tables, ignored_tables)
    if ignored_datasets is not None:
        tables = ignore_datasets(tables, ignored_datasets)
    return tables
