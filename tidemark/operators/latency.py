"""Which tables are stale, and under which threshold."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import (
    as_of_instant,
    elapsed_hours,
    hour_boundaries,
    hours,
    local_time,
    utc_instant,
)
from tidemark.operators.exclusion import exclude
from tidemark.operators.latest import latest_per_key
from tidemark.operators.matching import NESTED_LOOP_RULES, match_violated
from tidemark.operators.scope import has_default_threshold, live_tables
from tidemark.presets import DEFAULT_HOURS, DISPLAY_ZONE, MONITORED, Scope


def eligible_tables(
    matched: DataFrame, scope: Scope = MONITORED, default_hours: int = DEFAULT_HOURS
) -> DataFrame:
    """Keep tables that a pattern fits or whose dataset has the default, with their hours."""
    return matched.filter(
        F.col("table_pattern").isNotNull() | has_default_threshold(scope)
    ).withColumn("latency_threshold", F.coalesce("latency_threshold", F.lit(default_hours)))


def stale_matches(eligible: DataFrame, as_of: datetime | str | Column | None) -> DataFrame:
    """Keep the matches whose table is older than the threshold, strictly and to the instant."""
    return eligible.filter(_violated(eligible, as_of))


def _violated(tables: DataFrame, as_of: datetime | str | Column | None) -> Column:
    modified = utc_instant(tables, "storage_last_modified_time")
    return modified < as_of_instant(as_of) - hours(F.col("latency_threshold"))


def pick_threshold(stale: DataFrame) -> DataFrame:
    """One row per stale table: the threshold with the longest pattern among those violated."""
    order = [
        F.desc("storage_last_modified_time"),
        F.desc(F.length("table_pattern")),
        F.asc("table_pattern"),
        F.asc("latency_threshold"),
    ]
    return latest_per_key(stale, ["table_schema", "table_name"], order).drop("table_pattern")


def describe(
    stale: DataFrame,
    as_of: datetime | str | Column | None,
    zone: str = DISPLAY_ZONE,
    hour_mode: str = "elapsed",
) -> DataFrame:
    """What is shown of a stale table: its time in the display zone and its age in whole hours.

    ``elapsed`` counts hours that have passed, ``boundary`` full hours on the clock of
    the display zone. Neither decides what is stale.
    """
    if hour_mode not in ("elapsed", "boundary"):
        raise ValueError(f"hour_mode must be 'elapsed' or 'boundary', not {hour_mode!r}")
    now = as_of_instant(as_of)
    modified = utc_instant(stale, "storage_last_modified_time")
    local = local_time(modified, zone)
    age = (
        elapsed_hours(modified, now)
        if hour_mode == "elapsed"
        else hour_boundaries(local, local_time(now, zone))
    )
    return stale.select(
        "table_schema",
        "table_name",
        local.alias("last_update"),
        "latency_threshold",
        age.alias("hours_since_last_update"),
        "present_in_projects",
    )


def _old_enough(tables: DataFrame, thresholds: DataFrame, now: Column, default_hours: int) -> DataFrame:
    """Drop tables younger than every threshold there is: no match could make them stale."""
    shortest = thresholds.agg(
        F.least(F.min("latency_threshold"), F.lit(default_hours)).alias("hours")
    ).scalar()
    return tables.filter(utc_instant(tables, "storage_last_modified_time") < now - hours(shortest))


def _one_per_pattern(thresholds: DataFrame) -> DataFrame:
    """Keep the shortest threshold of each pattern.

    It is violated whenever a longer one of the same pattern is, and is the one picked.
    So a pattern listed very often does not multiply the tables it fits.
    """
    return thresholds.groupBy("table_pattern").agg(F.min("latency_threshold").alias("latency_threshold"))


def evaluate(
    activity: DataFrame,
    thresholds: DataFrame,
    ignored_datasets: DataFrame | None = None,
    ignored_tables: DataFrame | None = None,
    as_of: datetime | str | Column | None = None,
    scope: Scope = MONITORED,
    default_hours: int = DEFAULT_HOURS,
    zone: str = DISPLAY_ZONE,
    hour_mode: str = "elapsed",
    nested_loop_rules: int = NESTED_LOOP_RULES,
) -> DataFrame:
    """The stale tables.

    Violation is tested before the longest pattern is chosen, so a table whose
    longest pattern is satisfied is still reported under a shorter one it violates.
    """
    kind = thresholds.schema["latency_threshold"].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"latency_threshold must be a whole number of hours, not {kind.simpleString()}")
    tables = live_tables(activity, scope)
    tables = _old_enough(tables, thresholds, as_of_instant(as_of), default_hours)
    tables = exclude(tables, ignored_datasets, ignored_tables)
    rules = _one_per_pattern(thresholds)
    matched = match_violated(tables, rules, _violated(tables, as_of), nested_loop_rules)
    eligible = eligible_tables(matched, scope, default_hours)
    return describe(pick_threshold(stale_matches(eligible, as_of)), as_of, zone, hour_mode)
