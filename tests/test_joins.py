"""The spread join is a left join, and heavy keys end up in many tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import heavy_keys, spread_left_join


@pytest.fixture
def sides(spark):
    # A third of either side has key 0; some keys are on one side only, some are NULL.
    left = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("a"),
    )
    right = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 70 == 1, None).otherwise(F.col("id") % 400).alias("k"),
        (F.col("id") % 450).alias("b"),
    )
    return left, right


@pytest.mark.parametrize("rows_per_part", [1, 7, 100, 10_000])
def test_equals_a_left_join(sides, rows_per_part):
    left, right = sides
    expected = Counter(map(tuple, left.join(right, "k", "left").select("k", "a", "b").collect()))
    got = spread_left_join(left, right, ["k"], rows_per_part)
    assert got.columns == ["k", "a", "b"]
    assert Counter(map(tuple, got.collect())) == expected


def test_a_heavy_key_is_in_many_tasks(conf, sides):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    left, right = sides

    def tasks(df):
        return df.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()

    assert tasks(left.hint("merge").join(right, "k", "left")) == 1
    assert tasks(spread_left_join(left, right, ["k"], 10)) > 4


def test_equal_rows_under_one_key_are_dealt_out(spark, conf):
    """Facts that do not differ at all reach more than half of the parts."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    left = spark.createDataFrame([("orders",), ("other",)], "k string")
    right = spark.range(1000).select(F.lit("orders").alias("k"), F.lit("same").alias("fact"))
    joined = spread_left_join(left, right, ["k"], 10)
    assert Counter(map(tuple, joined.collect())) == {("orders", "same"): 1000, ("other", None): 1}
    tasks = joined.filter("k = 'orders'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4  # of 8


def test_two_keys_of_other_types(spark):
    left = spark.range(40).select((F.col("id") % 4).alias("n"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('"x'), F.col("id") % 3)).alias("t"), "id")
    right = spark.range(300).select((F.col("id") % 2).alias("n"), F.when(F.col("id") % 7 > 0, F.concat(F.lit('"x'), F.col("id") % 2)).alias("t"), F.col("id").alias("fact"))
    expected = Counter(map(tuple, left.join(right, ["n", "t"], "left").select("n", "t", "id", "fact").collect()))
    assert Counter(map(tuple, spread_left_join(left, right, ["n", "t"], 5).collect())) == expected


def test_only_heavy_keys_are_named(spark):
    right = spark.range(10_000).select(F.when(F.col("id") < 4000, F.lit("big")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    assert heavy_keys(right, ["k"], 1000) == {"big": 4}
    assert heavy_keys(right, ["k"], 5000) == {} and heavy_keys(right.limit(0), ["k"]) == {}
    plain = spread_left_join(right, right.withColumnRenamed("id", "other"), ["k"], 5000)
    assert "explode" not in plain._jdf.queryExecution().optimizedPlan().toString(), "without heavy keys it is the plain join"
