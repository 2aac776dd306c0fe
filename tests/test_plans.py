"""What Spark makes of the plans: no needless shuffle, no Python, heavy keys split."""

import pytest
from pyspark.sql import functions as F

import tidemark as td
from tidemark.plans import fixtures as fx
from tidemark.plans import workload


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stale(spark, sf_dir):
    return plan(workload._stale_tables(spark, sf_dir, opted_out=True))


def test_evaluation_shuffles_twice_for_the_activity(stale):
    """Once per (dataset, table, project), once per (dataset, table); the rest reuses the latter."""
    on_the_way = [
        line for line in stale[: stale.index("FileScan")].splitlines() if "Exchange hashpartitioning" in line
    ]
    assert len(on_the_way) == 2
    assert "hashpartitioning(table_schema" in on_the_way[0]


def test_anti_joins_and_one_nested_loop(stale):
    assert stale.count("LeftAnti") == 2
    assert stale.count("BroadcastNestedLoopJoin BuildRight, LeftOuter") == 1
    assert "WindowGroupLimit" in stale


def test_raw_rows_are_folded_by_a_hash_aggregate_before_the_shuffle(stale):
    before_scan = stale[: stale.index("FileScan")]
    aggregates = [line for line in before_scan.splitlines() if "Aggregate" in line]
    assert "HashAggregate" in aggregates[-1] and "partial_max" in aggregates[-1]
    assert "ObjectHashAggregate" not in aggregates[-1]


def test_scan_reads_the_needed_columns_and_gets_the_filter(stale):
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in stale
    assert "LessThanOrEqual(value,60.0)" in stale


@pytest.mark.parametrize("key", ["latest_source_tables", "latest_sources", "latest_job_stats"])
def test_latest_rows_are_picked_before_the_shuffle(spark, sf_dir, key):
    text = plan(workload.ENTRIES[key].query(spark, sf_dir))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_long_rule_list_joins_on_a_key(spark, sf_dir):
    tables = td.live_tables(fx.relation(spark, sf_dir, fx.LINEITEM_ACTIVITY), fx.SCOPE)
    text = plan(td.match_thresholds(tables, fx.relation(spark, sf_dir, fx.MANY_THRESHOLDS), 8))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_long_threshold_list_scans_the_rules_once(spark, sf_dir, tmp_path):
    """The prepared rules are stored: the plan holds no scan of where they come from."""
    tables = td.live_tables(fx.relation(spark, sf_dir, fx.LINEITEM_ACTIVITY), fx.SCOPE)
    text = plan(td.match_thresholds(tables, fx.relation(spark, sf_dir, fx.MANY_THRESHOLDS), 8))
    assert "supplier.parquet" not in text and "Window" not in text


def test_long_regex_list_joins_on_a_key(spark, sf_dir):
    rules = fx.relation(spark, sf_dir, fx.MANY_RULES)
    ids = spark.range(10).select(F.col("id").cast("string").alias("name"))
    text = plan(td.match_regex(ids, rules, "name", 8))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_routing_reads_no_more_than_the_id_for_the_patterns(spark, sf_dir):
    """Patterns meet distinct ids; the rest of a record is read once, for the result."""
    rules = td.rules_from_json(spark, fx.ROUTING)
    records = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("source", "table_schema")
    text = plan(td.route(records, rules))
    assert text.count("ReadSchema: struct<source:string>") == 1
    assert text.count("text:string") == 1 and "NestedLoop" not in text and "Cartesian" not in text


def test_no_python_in_any_plan(spark, sf_dir):
    for name, entry in workload.ENTRIES.items():
        if name in ("daily_run", "violations_roundtrip"):  # they read back what they stored
            continue
        text = plan(entry.query(spark, sf_dir))
        for word in ("Python", "Pandas", "Arrow"):
            assert word not in text, name


def test_summary_has_no_window_over_everything(spark, sf_dir):
    """Without groups the running length is over the few lines that could fit."""
    counts = td.dataset_counts(fx.relation(spark, sf_dir, fx.NAMED_RECORDS))
    text = plan(td.summary_lines(counts))
    assert "TakeOrderedAndProject" in text[text.index("Window"):]


def test_spark_splits_a_heavy_table_name(spark, conf, sf_dir):
    """The report's join: a name that holds a third of all rows is split at run time."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    n = 60_000
    name = F.when(F.col("id") % 3 == 0, "orders").otherwise(F.concat(F.lit("t"), "id"))
    stale = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("d"), "id").alias("table_schema"),
        name.alias("table_name"),
        F.lit(None).cast("timestamp_ntz").alias("last_update"),
        F.lit(24).alias("latency_threshold"),
        F.col("id").alias("hours_since_last_update"),
        F.array(F.lit("p")).alias("present_in_projects"),
    )
    facts = spark.range(0, n // 10, 1, 8).select(
        F.when(F.col("id") == 0, "orders").otherwise(F.concat(F.lit("t"), "id")).alias("table_name"),
        *(F.lit("x").alias(c) for c in ("companyid", "platform", "source_status", "lasterror")),
        F.lit(1).alias("lasterrorcode"),
        F.lit(None).cast("timestamp_ntz").alias("last_job_end_time"),
    )
    report = td.report(stale, facts)
    report.collect()
    assert "skew=true" in plan(report)
