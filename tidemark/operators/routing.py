"""Who hears of which record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.matching import NESTED_LOOP_RULES, counted, match_regex
from tidemark.presets import DATASET_ID_COLUMNS

ROUTE_COLUMNS = ["route", "is_default", "channels"]


def dataset_id(df: DataFrame, id_columns: Sequence[str] = DATASET_ID_COLUMNS) -> Column:
    """First of the id columns that is not NULL, empty or not, as text."""
    present = [F.col(column).cast("string") for column in id_columns if column in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def has_id(column: str) -> Column:
    """Whether a record has a dataset id to match on."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def route_key(is_default: Column, channels: Column) -> Column:
    """Text that names a route. A matched route with the default's channels stays apart."""
    kind = F.when(is_default, F.lit("default:")).otherwise(F.lit("match:"))
    return F.concat(kind, F.array_join(channels, ","))


def with_routes(rules: DataFrame) -> DataFrame:
    """Rules with the route they lead to: the ordered list of channels, repeats dropped."""
    listed = F.when(F.col("is_default"), F.col("channels")).otherwise(F.array_distinct("channels"))
    return rules.withColumn("channels", listed).withColumn(
        "route", route_key(F.col("is_default"), F.col("channels"))
    )


def with_default(rules: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Rules that are sure to have a default: the one they have, else these channels."""
    listed = F.array(*(F.lit(channel) for channel in channels))
    spare = rules.sparkSession.range(1).select(
        F.lit(0).alias("rule_no"),
        F.lit(None).cast("string").alias("pattern"),
        listed.alias("channels"),
        F.lit(True).alias("is_default"),
    )
    own = rules.filter(F.col("is_default")).select(F.col("is_default"))
    return rules.unionByName(spare.join(own, "is_default", "left_anti"))


def route(
    records: DataFrame,
    rules: DataFrame,
    id_columns: Sequence[str] = DATASET_ID_COLUMNS,
    dedupe: bool = False,
    fallback_channels: Sequence[str] | None = None,
    nested_loop_rules: int = NESTED_LOOP_RULES,
) -> DataFrame:
    """Each record once for every default rule and once per rule found in its dataset id.

    Two rules with the same channels list a record twice in that route, unless ``dedupe`` is
    set. Patterns meet the distinct ids only; the records are read once and get the routes of
    their id. ``fallback_channels`` stand in for a default that the rules lack; without either,
    records that no rule finds would reach nobody, so that is a ValueError.
    """
    if fallback_channels:
        rules = with_default(rules, fallback_channels)
    elif rules.filter(F.col("is_default")).isEmpty():
        raise ValueError("no default channel and no fallback")
    rules = with_routes(rules)
    named = F.struct(*ROUTE_COLUMNS)
    defaults = rules.filter(F.col("is_default")).agg(F.array_sort(F.collect_list(named)).alias("d"))
    with_id = records.withColumn("_id", dataset_id(records, id_columns))
    ids = with_id.filter(has_id("_id")).select("_id").distinct()
    # Rules alike in pattern and route are one with a count, and so are the finds of an id: nothing is collected.
    listed = counted(rules.filter(~F.col("is_default")).select("pattern", *ROUTE_COLUMNS)).drop("_turn")
    found = match_regex(ids, listed, "_id", nested_loop_rules).drop("pattern")
    found = counted(found, F.col("_times"))
    if dedupe:
        found = found.filter(F.col("_turn") == 0).withColumn("_times", F.lit(1))
        defaults = defaults.select(F.array_distinct("d").alias("d"))
    # The first find of an id brings the defaults along, so that a record reaches them once.
    nth = F.row_number().over(Window.partitionBy("_id").orderBy(*ROUTE_COLUMNS, "_turn"))
    found = found.select(F.col("_id").alias("_found_id"), named.alias("_route"), "_times", (nth == 1).alias("_first"))
    routed = with_id.join(found, F.col("_id") == F.col("_found_id"), "left")
    none = F.array().cast(T.ArrayType(found.schema["_route"].dataType))
    own = F.when(F.col("_times").isNotNull(), F.array_repeat("_route", F.col("_times"))).otherwise(none)
    first = F.when(F.coalesce("_first", F.lit(True)), defaults.scalar()).otherwise(none)
    return routed.select(*records.columns, F.inline(F.concat(first, own)))
