"""Why a table is stale: the state and last error of the job that feeds it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import local_time, second_text, utc_from_millis
from tidemark.operators.joins import spread_left_join
from tidemark.operators.latest import latest_per_key
from tidemark.presets import (
    ACTIVE_STATUS,
    DISPLAY_ZONE,
    RUNTIME_COLUMN,
    STATUS_NAMES,
    UNKNOWN_STATUS,
)
from tidemark.sources.schemas import JOB_STATS, SOURCE_TABLES, SOURCES, conform, with_runtime


def _newest(
    history: DataFrame, keys: list[str], columns: list[str], runtime: str, tiebreak: Sequence[str]
) -> DataFrame:
    """The newest row per key, with these columns.

    Rows that tie in everything named are told apart by a hash, so that a task that is
    run again, or a second reader of the plan, picks the same row.
    """
    needed = history.select(*dict.fromkeys([*keys, *columns, runtime, *tiebreak]))
    order = [F.desc(runtime), *(F.desc(column) for column in tiebreak)]
    return latest_per_key(needed, keys, [*order, F.xxhash64(*needed.columns)])


def status_name(code: Column) -> Column:
    """A status code in words; NULL and codes not listed are unknown."""
    words = F.lit(None).cast("string")
    for number, word in STATUS_NAMES.items():
        words = F.when(code == number, F.lit(word)).otherwise(words)
    return F.coalesce(words, F.lit(UNKNOWN_STATUS))


def latest_source_tables(
    history: DataFrame, runtime: str = RUNTIME_COLUMN, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Latest active row per source table.

    Filtered first: an older active row stands in for a newer inactive one.
    """
    active = history.filter((F.col("selected") == F.lit(True)) & (F.col("status") == ACTIVE_STATUS))
    columns = ["tableid", "sourceid", "companyid", "status", "tablename"]
    return _newest(active, ["sourceid", "tableid"], columns, runtime, tiebreak).select(*columns)


def latest_sources(
    history: DataFrame, runtime: str = RUNTIME_COLUMN, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Latest row per source, with its status in words."""
    columns = ["sourceid", "companyid", "type", "status", "name"]
    latest = _newest(history, ["sourceid"], columns, runtime, tiebreak).select(*columns)
    return latest.withColumn("status", status_name(F.col("status")))


def latest_job_stats(
    history: DataFrame,
    zone: str = DISPLAY_ZONE,
    runtime: str = RUNTIME_COLUMN,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Latest job result per (source, table name), with its end time in ``zone``."""
    columns = ["tableid", "sourceid", "lasterrorcode", "lasterror", "lastendtime"]
    latest = _newest(history, ["sourceid", "tablename"], columns, runtime, tiebreak)
    ended = local_time(utc_from_millis(latest, "lastendtime"), zone)
    return latest.select(
        "tableid", "sourceid", "lasterrorcode", "lasterror", ended.alias("last_job_end_time")
    )


def _left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: bool) -> DataFrame:
    return spread_left_join(left, right, keys) if spread else left.join(right, keys, "left")


def enrichment(
    source_tables: DataFrame,
    sources: DataFrame,
    job_stats: DataFrame,
    zone: str = DISPLAY_ZONE,
    strict_key: bool = False,
    runtime: str = RUNTIME_COLUMN,
    tiebreak: Sequence[str] = (),
    only_for: DataFrame | None = None,
    spread: bool = False,
) -> DataFrame:
    """Job facts by table name, from the three histories.

    Job results join on ``tableid`` alone, which repeats a table once per source
    that numbers a table alike; ``strict_key`` joins on the source as well.
    ``only_for`` holds a ``table_name`` column: other tables are dropped before the
    job results multiply them. Results for the names it holds do not change.

    ``spread`` is for a ``tableid`` that very many job results share, see
    ``spread_left_join``.
    """
    for history, schema in ((source_tables, SOURCE_TABLES), (sources, SOURCES), (job_stats, JOB_STATS)):
        conform(history, with_runtime(schema, runtime))  # raises TypeError
    tables = latest_source_tables(source_tables, runtime, tiebreak)
    named = latest_sources(sources, runtime, tiebreak).select(
        "sourceid", F.col("type").alias("platform"), F.col("status").alias("source_status"), "name"
    )
    stats = latest_job_stats(job_stats, zone, runtime, tiebreak)
    key = ["sourceid", "tableid"] if strict_key else ["tableid"]
    described = tables.join(named, "sourceid", "left").select(
        "tableid",
        "sourceid",
        "companyid",
        "platform",
        "source_status",
        F.concat("name", F.lit("_"), "tablename").alias("table_name"),
    )
    if only_for is not None:
        described = described.join(only_for.select("table_name").distinct(), "table_name", "left_semi")
    facts = ["lasterrorcode", "lasterror", "last_job_end_time"]
    return _left_join(described, stats.select(*key, *facts), key, spread).select(
        "companyid", "platform", "source_status", *facts, "table_name"
    )


def report_order() -> list[Column]:
    """Oldest first; names settle ties."""
    return [F.desc("hours_since_last_update"), F.asc("table_schema"), F.asc("table_name")]


def report(stale: DataFrame, facts: DataFrame, spread: bool = False, ordered: bool = True) -> DataFrame:
    """The report: each stale table with the job facts of every table of that name.

    ``spread`` is for a name that very many facts share; ``facts`` is then read twice.
    ``ordered=False`` leaves out the sort, for rows that are to be stored.
    """
    facts = facts.filter(F.col("table_name").isNotNull()).drop("companyid")
    rows = (
        _left_join(stale, facts, ["table_name"], spread)
        .select(
            "table_schema",
            "table_name",
            second_text(F.col("last_update")).alias("last_update"),
            "latency_threshold",
            "hours_since_last_update",
            "present_in_projects",
            "platform",
            "source_status",
            "lasterrorcode",
            "lasterror",
            second_text(F.col("last_job_end_time")).alias("last_job_end_time"),
        )
    )
    return rows.orderBy(*report_order()) if ordered else rows
