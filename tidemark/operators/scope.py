"""Which tables are looked at, and when each was last modified."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import any_of
from tidemark.presets import MONITORED, Scope


def _dataset_tests(patterns, upper_patterns) -> list[Column]:
    dataset = F.col("table_schema")
    return [dataset.like(p) for p in patterns] + [F.upper(dataset).like(p) for p in upper_patterns]


def has_default_threshold(scope: Scope) -> Column:
    """Whether a table nothing matched is still held to the default threshold."""
    return any_of(_dataset_tests(scope.default_patterns, scope.default_upper_patterns))


def in_scope(scope: Scope) -> Column:
    """Scope and exclusions as one predicate. A NULL test drops the row, as in SQL."""
    dataset, project, table = F.col("table_schema"), F.col("source_project_id"), F.col("table_name")
    wanted = _dataset_tests(scope.patterns, scope.upper_patterns)
    if scope.datasets:
        wanted.append(dataset.isin(*scope.datasets))
    tests = [any_of(wanted)] if wanted else []
    if scope.excluded_datasets:
        tests.append(~dataset.isin(*scope.excluded_datasets))
    tests += [~((project == p) & (dataset == d)) for p, d in scope.excluded_pairs]
    tests += [table != name for name in scope.excluded_tables]
    return reduce(and_, tests, F.lit(True))


def scope_filter(activity: DataFrame, scope: Scope = MONITORED) -> DataFrame:
    """Rows of tables that exist and are in scope."""
    return activity.filter(F.col("deleted") == F.lit(False)).filter(in_scope(scope))


def live_tables(activity: DataFrame, scope: Scope = MONITORED) -> DataFrame:
    """One row per (dataset, table) with its latest time and the projects that hold it.

    Two steps on purpose. The first keeps one time per (dataset, table, project) in
    a hash aggregate, which folds the rows of a busy table inside each map task.
    Only those few rows reach ``collect_set``: its aggregate keeps objects and goes
    over to sorting after a small number of keys, too slow for the raw rows.
    """
    per_project = (
        scope_filter(activity, scope)
        .groupBy("table_schema", "table_name", "source_project_id")
        .agg(F.max("storage_last_modified_time").alias("storage_last_modified_time"))
    )
    return per_project.groupBy("table_schema", "table_name").agg(
        F.max("storage_last_modified_time").alias("storage_last_modified_time"),
        F.sort_array(F.collect_set("source_project_id")).alias("present_in_projects"),
    )
