"""The daily run: collect, check, report. Each step stores what the next one reads.

Stored tables cut the plan between steps: no step repeats the scans of the one
before, and a lost executor costs a step's own tasks only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrichment import enrichment, report
from tidemark.operators.export import publish_report
from tidemark.operators.latency import evaluate
from tidemark.operators.routing import route
from tidemark.operators.rules import rules_from_json
from tidemark.operators.summary import route_summary
from tidemark.presets import DEFAULT_HOURS, DISPLAY_ZONE, MONITORED, RUNTIME_COLUMN, Scope
from tidemark.sources.activity import opt_out_datasets, read_source, table_activity, union_sources
from tidemark.sources.schemas import (
    ACTIVITY,
    IGNORED_DATASETS,
    IGNORED_TABLES,
    OPTIONS,
    THRESHOLDS,
    conform,
)
from tidemark.sources.staging import read_table, read_violations, replace_table
from tidemark.sources.versions import commit, current, dropped, new_version, written

Sources = Mapping[str, str | DataFrame | Iterable[str | DataFrame]]


@dataclass(frozen=True)
class Workspace:
    """A folder that all executors reach, and the tables in it. Each attribute is the folder to read now."""

    folder: str

    def table(self, name: str) -> str:
        """Where a table's versions lie, to be replaced there."""
        return f"{self.folder}/{name}"

    def _now(self, name: str) -> str:
        return current(SparkSession.active(), self.table(name))

    @property
    def activity(self) -> str:
        return self._now("table_storage")

    @property
    def opted_out(self) -> str:
        return self._now("dataset_labels")

    @property
    def stale(self) -> str:
        return self._now("stale_tables")

    @property
    def facts(self) -> str:
        return self._now("job_facts")

    @property
    def violations(self) -> str:
        return self._now("latency_violations")

    @property
    def routed(self) -> str:
        return self._now("routed_violations")

    @property
    def report(self) -> str:
        return self._now("report")


def collect(
    spark: SparkSession, work: Workspace, activity: Sources, options: Sources
) -> DataFrame:
    """Stage activity and opted-out datasets of all projects. Returns the rows of each, counted while writing.

    Activity is folded before it is stored: its latest time per table, project and mark.
    No activity at all is an error, and then nothing is replaced.
    """
    rows = union_sources(spark, activity)
    # One row per table, project and mark: nothing later asks for more of the raw rows.
    names = ("source_project_id", "table_schema", "table_name", "storage_last_modified_time", "deleted")
    version = new_version(spark, work.table("table_storage"))
    stored = written(table_activity(rows, *(F.col(name) for name in names)), version)
    if not stored:
        dropped(spark, version)
        raise RuntimeError("table activity has no rows; there is nothing to check")
    commit(spark, version)
    labels = replace_table(opt_out_datasets(union_sources(spark, options, OPTIONS)), work.table("dataset_labels"))
    counts = [("table_storage_rows", stored), ("dataset_labels_rows", labels)]
    return spark.createDataFrame(counts, "input string, row_count bigint")


def check(
    spark: SparkSession,
    work: Workspace,
    thresholds: DataFrame,
    ignored_tables: DataFrame,
    source_tables: DataFrame,
    sources: DataFrame,
    job_stats: DataFrame,
    as_of: datetime | str | Column | None = None,
    scope: Scope = MONITORED,
    default_hours: int = DEFAULT_HOURS,
    zone: str = DISPLAY_ZONE,
    hour_mode: str = "elapsed",
    runtime: str = RUNTIME_COLUMN,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Store the report of all stale tables and return it.

    The stale tables are stored first: their names then cut down the job facts
    before those are joined, and the activity is read once. The facts are stored too,
    so that the join with them can be spread.
    """
    stale = evaluate(
        read_source(spark, work.activity, ACTIVITY),
        conform(thresholds, THRESHOLDS),
        read_source(spark, work.opted_out, IGNORED_DATASETS),
        conform(ignored_tables, IGNORED_TABLES),
        as_of,
        scope,
        default_hours,
        zone,
        hour_mode,
    )
    replace_table(stale, work.table("stale_tables"))
    stale = read_table(spark, work.stale)
    facts = enrichment(
        source_tables, sources, job_stats, zone, runtime=runtime, tiebreak=tiebreak, only_for=stale
    )
    replace_table(facts, work.table("job_facts"))
    violations = report(stale, read_table(spark, work.facts), spread=True, ordered=False)
    replace_table(violations, work.table("latency_violations"))
    return read_violations(spark, work.violations)


def publish(
    spark: SparkSession, work: Workspace, routing: str, file_format: str = "parquet"
) -> DataFrame:
    """Write one report per route and return what each route is told."""
    rules = rules_from_json(spark, routing)
    replace_table(route(read_table(spark, work.violations), rules), work.table("routed_violations"))
    routed = read_table(spark, work.routed)
    publish_report(routed, work.table("report"), file_format)
    return route_summary(routed, rules)
