"""Where last-modified times come from."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.presets import OPT_OUT_OPTION, OPT_OUT_PATTERN
from tidemark.sources.schemas import ACTIVITY, OPTIONS, conform
from tidemark.sources.versions import read_current

_MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")
_NAMES = ("table_schema", "table_name", "schema_name", "option_name")


def table_activity(
    rows: DataFrame,
    project: Column,
    dataset: Column,
    table: Column,
    modified: Column,
    deleted: Column | None = None,
) -> DataFrame:
    """Activity taken from the data itself: the latest time seen per table.

    Rows marked deleted are kept apart, so that dropping them later has the same
    result as dropping them here. Each map task folds its rows before the shuffle.
    """
    return rows.groupBy(
        project.alias("source_project_id"),
        dataset.alias("table_schema"),
        table.alias("table_name"),
        (F.lit(False) if deleted is None else deleted).alias("deleted"),
    ).agg(F.max(modified).alias("storage_last_modified_time")).select(*ACTIVITY.fieldNames())


_TABLE_FOLDER = r"(/[^/=]+=[^/]*)*/part-[^/]*$"


def listed_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """A row for each file, with its table, dataset, time, size and place; no file is opened.

    The table is the folder of a file that Spark wrote, without folders of partitions; any other
    file is a table of its own. The dataset is the folder above. Files of any kind count, empty
    ones too; names that begin with a dot or an underscore do not.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    steps = F.split(F.regexp_replace("path", _TABLE_FOLDER, ""), "/")
    return rows.select(
        F.element_at(steps, -2).alias("table_schema"),
        F.regexp_replace(F.element_at(steps, -1), r"\.[^.]*$", "").alias("table_name"),
        F.col("modificationTime").alias("storage_last_modified_time"),
        F.col("length").alias("bytes"),
        "path",
        F.col("_metadata.file_path").alias("file"),  # as Parquet scans name it, escaped
    )


def rows_per_file(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """file, row_count: how many rows each Parquet file has, 0 for none; no column is read."""
    rows = spark.read.schema(T.StructType([])).option("recursiveFileLookup", "true").parquet(*paths)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("row_count"))
    listed = listed_files(spark, paths).select("file").join(counts, "file", "left")
    return listed.select("file", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def file_activity(spark: SparkSession, paths: Iterable[str], project: str) -> DataFrame:
    """Activity taken from files: for each table the time its newest file was changed, whatever the file holds."""
    return table_activity(
        listed_files(spark, paths),
        F.lit(project),
        F.col("table_schema"),
        F.col("table_name"),
        F.col("storage_last_modified_time"),
    )


def _open(spark: SparkSession, source: str | DataFrame, schema: T.StructType) -> DataFrame | None:
    """A DataFrame, path or catalog table as a DataFrame; None if there is no such thing.

    A folder without files has the schema and no rows.
    """
    if isinstance(source, DataFrame):
        return source
    try:
        df = read_current(spark, source) if "/" in source else spark.table(source)
        df.schema  # resolve now, so that a missing table shows here
        return df
    except AnalysisException as error:
        if error.getCondition() in _MISSING:
            return None
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return spark.createDataFrame([], schema)
        raise


def read_source(spark: SparkSession, source: str | DataFrame, schema: T.StructType) -> DataFrame:
    """One input table, its columns checked. Raises FileNotFoundError if there is none."""
    df = _open(spark, source, schema)
    if df is None:
        raise FileNotFoundError(source)
    return conform(df, schema)


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_sources(
    spark: SparkSession,
    sources: Mapping[str, str | DataFrame | Iterable[str | DataFrame]],
    schema: T.StructType = ACTIVITY,
    on_missing: str = "skip",
) -> DataFrame:
    """Activity of many projects as one relation, each row tagged with its project.

    ``sources`` maps a project to one source or to several (one per region). A source
    that does not exist is left out with a warning, or with ``on_missing="error"`` raises
    FileNotFoundError. With no source left the result has the schema and no rows. A source may lack
    columns that others have, names aside: they are NULL for its rows, with a warning.
    """
    if on_missing not in ("skip", "error"):
        raise ValueError(f"on_missing must be 'skip' or 'error', not {on_missing!r}")
    own = T.StructType([f for f in schema.fields if f.name != "source_project_id"])
    tagged = "source_project_id" in schema.fieldNames()
    frames = []
    for project, given in sources.items():
        for source in [given] if isinstance(given, (str, DataFrame)) else given:
            df = _open(spark, source, own)
            if df is None:
                if on_missing == "error":
                    raise FileNotFoundError(source)
                warnings.warn(f"no source {source} of {project}", stacklevel=2)
                continue
            df = conform(_filled(df, own, f"source {source} of {project}" if isinstance(source, str) else f"a source of {project}"), own)
            if tagged:
                df = df.withColumn("source_project_id", F.lit(project)).select(*schema.fieldNames())
            frames.append(df)
    return union_frames(frames) if frames else spark.createDataFrame([], schema)


def _filled(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    """With NULL for the columns that are absent, except for names, which a row needs."""
    absent = [f for f in schema.fields if f.name not in df.columns and f.name not in _NAMES]
    if absent and len(absent) < len(schema.fields) - 1:
        warnings.warn(f"{what} has no {', '.join(f.name for f in absent)}", stacklevel=3)
        return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    return df


def opt_out_datasets(
    options: DataFrame, option: str = OPT_OUT_OPTION, pattern: str = OPT_OUT_PATTERN
) -> DataFrame:
    """Datasets whose labels ask to be left alone."""
    wanted = (F.col("option_name") == option) & F.col("option_value").like(pattern)
    return conform(options, OPTIONS).filter(wanted).select("schema_name").distinct()


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or RuntimeError if it is empty. Stops at the first row found."""
    if df.isEmpty():
        raise RuntimeError(f"{what} has no rows; there is nothing to check")
    return df
