"""Reports as plain text columns and files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import iso_text
from tidemark.presets import ALL_CLEAR_REPORT, WIDTH_CAP, WIDTH_PADDING
from tidemark.sources.activity import listed_files
from tidemark.sources.versions import commit, current, new_version

ROWS_PER_FILE = 1_000_000
_MANIFEST = "_manifest"


def _plain(df: DataFrame, field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(df, field.name)
    return F.col(field.name)


def export_rows(df: DataFrame, arrays_as_text: bool = False) -> DataFrame:
    """Times as ISO text, missing times as NULL; arrays as JSON text where a format needs it."""
    columns = []
    for field in df.schema.fields:
        column = _plain(df, field)
        if arrays_as_text and isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _shown(df: DataFrame, field: T.StructField) -> Column:
    """A value as it is displayed in a cell; lists in brackets, their texts in quotes."""
    if isinstance(field.dataType, T.ArrayType):
        items = F.array_join(field.name, "', '")
        return F.when(F.size(field.name) == 0, F.lit("[]")).otherwise(
            F.concat(F.lit("['"), items, F.lit("']"))
        )
    return _plain(df, field).cast("string")


def column_widths(df: DataFrame, cap: int = WIDTH_CAP) -> DataFrame:
    """Display width of each column: its longest value or its header, padded, up to a cap.

    One aggregate over all columns at once, turned into a row per column afterwards.
    """
    longest = df.agg(
        *(
            F.greatest(
                F.lit(len(field.name)), F.coalesce(F.max(F.length(_shown(df, field))), F.lit(0))
            ).alias(field.name)
            for field in df.schema.fields
        )
    )
    widths = longest.unpivot([], df.columns, "column_name", "longest")
    return widths.select(
        F.col("column_name"),
        F.least(F.col("longest") + WIDTH_PADDING, F.lit(cap)).alias("width"),
    )


def empty_report(records: DataFrame) -> DataFrame:
    """The one-row message that stands for a report when there is nothing in it."""
    some = records.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return some.filter(F.col("n") == 0).select(F.lit(ALL_CLEAR_REPORT).alias("message"))


def write_report(routed: DataFrame, path: str, file_format: str = "parquet", rows_per_file: int = ROWS_PER_FILE) -> None:
    """One folder per route, replaced as a whole.

    The rebalance gathers each route's rows into files of a sensible size and splits
    a route that holds a large share of all rows over several tasks. No file has more rows than ``rows_per_file``.
    """
    rows = export_rows(routed, arrays_as_text=file_format == "csv")
    writer = rows.hint("rebalance", F.col("route")).write.mode("overwrite").partitionBy("route")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.option("maxRecordsPerFile", rows_per_file).format(file_format).save(path)


def write_report_or_message(
    routed: DataFrame, path: str, file_format: str = "parquet", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write the report, or the message if there is nothing to report."""
    if routed.isEmpty():
        empty_report(routed).write.mode("overwrite").format(file_format).save(path)
    else:
        write_report(routed, path, file_format, rows_per_file)


def publish_report(routed: DataFrame, target: str, file_format: str = "parquet", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the report, or the message, as a new version of the target, with a manifest of its files.

    The manifest (route, path, rows, format) is worked out from the files themselves, and lies with them. A
    reader sees the report before until the manifest is there too; a write that fails leaves that report.
    """
    spark = routed.sparkSession
    version = new_version(spark, target)
    write_report_or_message(routed, version, file_format, rows_per_file)
    files = spark.read.option("header", True).format(file_format).load(version)
    route = F.col("route").cast("string") if "route" in files.columns else F.lit(None).cast("string")
    counts = files.groupBy(route.alias("route"), F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    listed = listed_files(spark, [version]).select("file", "path")
    manifest = listed.join(counts, "file").select("route", "path", "rows", F.lit(file_format).alias("format"))
    manifest.coalesce(1).write.parquet(f"{version}/{_MANIFEST}")
    commit(spark, version)


def report_manifest(spark: SparkSession, target: str) -> DataFrame:
    """Route, path, rows and format of each file of the published report."""
    return spark.read.parquet(f"{current(spark, target)}/{_MANIFEST}")


def read_report(spark: SparkSession, target: str, routes: Sequence[str] | None = None) -> DataFrame:
    """The rows of the published report, or of some of its routes: the files that the manifest names, no others.

    Raises ValueError if there is no file for any of these routes.
    """
    version = current(spark, target)
    listed = spark.read.parquet(f"{version}/{_MANIFEST}")
    if routes is not None:
        listed = listed.where(F.col("route").isin(list(routes)))
    files = listed.select("path", "format").collect()  # as many as the report has files
    if not files:
        raise ValueError(f"no report for {routes}")
    reader = spark.read.option("basePath", version).option("header", True).format(files[0]["format"])
    return reader.load([r["path"] for r in files])
