"""Counts per dataset and the message texts made from them.

``by`` names grouping columns, such as the route; without it there is one summary
of everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import shortened
from tidemark.operators.routing import ROUTE_COLUMNS, with_routes
from tidemark.presets import (
    ALL_CLEAR_SUMMARY,
    ALL_CLEAR_TEMPLATE,
    HEADER_FORMAT,
    LINE_FORMAT,
    NAME_KEPT,
    NAME_LIMIT,
    REPORT_TEMPLATE,
    SUMMARY_BUDGET,
    TAIL_MANY,
    TAIL_ONE,
    UNKNOWN_DATASET,
)
from tidemark.sources.stored import stored


def dataset_counts(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Violations per dataset."""
    dataset = F.coalesce("table_schema", F.lit(UNKNOWN_DATASET)).alias("table_schema")
    return records.groupBy(*by, dataset).agg(F.count(F.lit(1)).alias("violations"))


def totals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Violations and datasets in all."""
    return counts.groupBy(*by).agg(
        F.coalesce(F.sum("violations"), F.lit(0)).alias("total_violations"),
        F.count(F.lit(1)).alias("total_datasets"),
    )


def _with_values(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The values of a one-row frame as columns of every row."""
    return df.withColumns({name: one_row.select(name).scalar() for name in one_row.columns})


def _most_first() -> list[Column]:
    return [F.desc("violations"), F.asc("table_schema")]


def top_datasets(counts: DataFrame, n: int = 5) -> DataFrame:
    """The datasets with the most violations."""
    return counts.orderBy(*_most_first()).limit(n)


def _header() -> Column:
    return F.format_string(HEADER_FORMAT, "total_violations", "total_datasets")


def summary_lines(
    counts: DataFrame, by: Sequence[str] = (), budget: int = SUMMARY_BUDGET
) -> DataFrame:
    """One line per dataset, most violations first, while header and lines fit the budget.

    Stops at the first line that does not fit. No more than ``budget`` divided by the
    shortest possible line can fit, so only that many datasets enter the running
    length; which ones they are is found without bringing the others together.
    """
    shortest = len(LINE_FORMAT.replace("%s", "") % 0) + 1
    most = budget // shortest + 1
    if by:
        ranked = Window.partitionBy(*by).orderBy(*_most_first())
        candidates = counts.withColumn("line_no", F.row_number().over(ranked)).filter(
            F.col("line_no") <= most
        )
        lines = candidates.join(totals(counts, by), list(by))
    else:
        ranked = Window.orderBy(*_most_first())
        candidates = counts.orderBy(*_most_first()).limit(most)
        candidates = candidates.withColumn("line_no", F.row_number().over(ranked))
        lines = _with_values(candidates, totals(counts))
    running = Window.partitionBy(*by).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    name = shortened(F.col("table_schema"), NAME_LIMIT, NAME_KEPT)
    return (
        lines.withColumn("line", F.format_string(LINE_FORMAT, name, "violations"))
        .withColumn(
            "length_so_far",
            (F.sum(F.length("line") + 1).over(running) + F.length(_header())).cast("bigint"),
        )
        .filter(F.col("length_so_far") <= budget)
    )


def summary_text(
    counts: DataFrame, by: Sequence[str] = (), budget: int = SUMMARY_BUDGET
) -> DataFrame:
    """The whole message per group: header, the lines that fit, how many are left out."""
    lines = summary_lines(counts, by, budget)
    shown = lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("shown"),
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_lines"),
    )
    everything = totals(counts, by)
    if by:
        joined = everything.join(shown, list(by), "left")
    else:
        joined = _with_values(everything, shown)
    joined = joined.withColumn("shown", F.coalesce("shown", F.lit(0)).cast("bigint"))
    left_out = F.col("total_datasets") - F.col("shown")
    tail = F.when(left_out == 1, F.format_string(TAIL_ONE, left_out)).when(
        left_out > 1, F.format_string(TAIL_MANY, left_out)
    )
    parts = F.concat(
        F.array(_header()),
        F.coalesce(
            F.transform("_lines", lambda each: each["line"]), F.array().cast("array<string>")
        ),
        F.array_compact(F.array(tail)),
    )
    text = F.when(F.col("total_violations") == 0, F.lit(ALL_CLEAR_SUMMARY)).otherwise(
        F.array_join(parts, "\n")
    )
    return joined.select(
        *by, "total_violations", "total_datasets", "shown", text.alias("summary_text")
    )


def route_summary(routed: DataFrame, rules: DataFrame, budget: int = SUMMARY_BUDGET) -> DataFrame:
    """One row per route: its channels, how many violations, which report, and the text.

    The default route is there even if nothing is stale; other routes need a record. Violations per
    route and dataset are worked out once and stored; everything else comes from them.
    """
    counts = stored(dataset_counts(routed, ROUTE_COLUMNS))
    texts = summary_text(counts, ROUTE_COLUMNS, budget)
    default = with_routes(rules).filter(F.col("is_default")).select(*ROUTE_COLUMNS)
    silent = default.join(counts.select("route").distinct(), "route", "left_anti")
    violations = F.coalesce("total_violations", F.lit(0)).cast("bigint")
    return texts.unionByName(silent, allowMissingColumns=True).select(
        *ROUTE_COLUMNS,
        violations.alias("violations"),
        F.when(violations > 0, F.lit(REPORT_TEMPLATE))
        .otherwise(F.lit(ALL_CLEAR_TEMPLATE))
        .alias("template"),
        F.coalesce("summary_text", F.lit(ALL_CLEAR_SUMMARY)).alias("summary_text"),
    )
