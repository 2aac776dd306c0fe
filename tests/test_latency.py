"""Which tables are stale: the cases that decide whether results are right."""

from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import tidemark as td
from tidemark.presets import MONITORED, Scope

NOW = datetime(2024, 1, 31)
ACTIVITY = (
    "source_project_id string, table_schema string, table_name string, "
    "storage_last_modified_time timestamp_ntz, deleted boolean"
)


def activity(spark, *rows):
    """Rows of (dataset, table, age in hours[, project[, deleted]])."""
    full = []
    for dataset, table, age, *rest in rows:
        project, deleted = (*rest, *("p", False)[len(rest):])
        full.append((project, dataset, table, NOW - timedelta(hours=age), deleted))
    return spark.createDataFrame(full, ACTIVITY)


def thresholds(spark, *rows):
    return spark.createDataFrame(list(rows), "table_pattern string, latency_threshold int")


def stale(spark, rows, rules, **options):
    found = td.evaluate(activity(spark, *rows), thresholds(spark, *rules), as_of=NOW, **options)
    return sorted(
        (r.table_schema, r.table_name, r.latency_threshold, r.hours_since_last_update)
        for r in found.collect()
    )


@pytest.mark.parametrize("nested_loop_rules", [64, 0])
def test_violation_is_tested_before_the_longest_pattern_is_chosen(spark, nested_loop_rules):
    rules = [("order%", 10), ("order_items%", 500), ("o%", 20)]
    found = stale(spark, [("d_prod_raw", "order_items", 48)], rules, nested_loop_rules=nested_loop_rules)
    assert found == [("d_prod_raw", "order_items", 10, 48)]


def test_longest_violated_pattern_wins_and_ties_are_settled(spark):
    rules = [("a%", 1), ("abc%", 3), ("ab%", 2), ("%bc", 9), ("%abc", 7), ("abc%", 4)]
    assert stale(spark, [("d_prod_raw", "abc", 48)], rules) == [("d_prod_raw", "abc", 7, 48)]


@pytest.mark.parametrize("nested_loop_rules", [64, 0])
def test_pattern_listed_often(spark, nested_loop_rules):
    rules = [("a%", 30), ("a%", None), ("a%", 20), ("a%", 100), ("b%", None), ("b%", None), ("b%", 70)]
    rows = [("daton_x", "a", 48), ("daton_x", "ab", 25), ("daton_x", "a1", 10), ("daton_x", "b", 48), ("daton_x", "c", 48)]
    found = stale(spark, rows, rules, nested_loop_rules=nested_loop_rules)
    assert [r[1:3] for r in found] == [("a", 20), ("ab", 20), ("c", 24)]


def test_comparison_is_strict_and_on_the_exact_time(spark):
    rows = [
        ("daton_x", "at_24", 24),
        ("daton_x", "just_over", 24 + 1e-6 / 3600 * 1),
        ("daton_x", "half_past", 24.5),
        ("daton_x", "under", 23.99),
    ]
    assert stale(spark, rows, []) == [("daton_x", "half_past", 24, 24), ("daton_x", "just_over", 24, 24)]


def test_hours_elapsed_and_on_the_clock(spark):
    # 00:00 UTC is 05:30 in Kolkata; 25.25 hours earlier it was 04:15 there.
    rows = [("daton_x", "t", 25.25), ("daton_x", "u", 25.75)]
    assert [r[3] for r in stale(spark, rows, [])] == [25, 25]
    assert [r[3] for r in stale(spark, rows, [], hour_mode="boundary")] == [25, 26]
    with pytest.raises(ValueError):
        stale(spark, rows, [], hour_mode="other")


def test_only_default_datasets_have_a_default(spark):
    rows = [("x_prod_raw", "t", 99), ("nexus_gds_raw", "t", 99), ("daton_x", "t", 99), ("myBq", "t", 99)]
    assert [r[0] for r in stale(spark, rows, [])] == ["daton_x", "myBq"]
    assert len(stale(spark, rows, [("t", 5)])) == 4
    assert [r[2] for r in stale(spark, rows, [], default_hours=50)] == [50, 50]


def test_satisfied_match_replaces_the_default(spark):
    assert stale(spark, [("daton_x", "t", 99)], [("t", 200)]) == []


def test_pattern_without_threshold_is_no_match(spark):
    rows = [("daton_x", "t", 30), ("x_prod_raw", "t", 30)]
    assert stale(spark, rows, [("t", None)]) == [("daton_x", "t", 24, 30)]


def test_only_the_name_is_lowered(spark):
    rows = [("x_prod_raw", "ORDERS", 30)]
    assert stale(spark, rows, [("orders", 1)]) != []
    assert stale(spark, rows, [("ORDERS", 1)]) == []


def test_scope_is_case_sensitive_and_underscore_is_a_wildcard(spark):
    rows = [
        (name, "t", 99)
        for name in ("aXprodYraw", "a_prod_raw", "prod_raw", "Daton_x", "x_daton_y", "MyBqSet", "nexus_gds_raw", "other")
    ]
    found = {r.table_schema for r in td.scope_filter(activity(spark, *rows)).collect()}
    assert found == {"aXprodYraw", "a_prod_raw", "x_daton_y", "MyBqSet", "nexus_gds_raw"}


def test_exclusions(spark):
    rows = [(name, "t", 1) for name in MONITORED.excluded_datasets]
    rows += [(d, "t", 1, p) for p, d in MONITORED.excluded_pairs]
    rows += [("daton_x", name, 1) for name in MONITORED.excluded_tables]
    assert td.scope_filter(activity(spark, *rows)).isEmpty()


def test_pair_exclusion_drops_one_copy_only(spark):
    scope = replace(MONITORED, excluded_pairs=(("p", "daton_x"),))
    rows = [("daton_x", "t", 5, "p"), ("daton_x", "t", 9, "q"), ("daton_x", "u", 9, "p")]
    (row,) = td.live_tables(activity(spark, *rows), scope).collect()
    assert (row.table_name, row.present_in_projects) == ("t", ["q"])
    assert row.storage_last_modified_time == NOW - timedelta(hours=9)


def test_null_project_is_dropped_only_where_the_dataset_is_paired(spark):
    scope = replace(MONITORED, excluded_pairs=(("p", "daton_x"),))
    rows = [("daton_x", "t", 5, None), ("daton_y", "t", 5, None)]
    assert [r.table_schema for r in td.scope_filter(activity(spark, *rows), scope).collect()] == ["daton_y"]


def test_deleted_or_unknown_rows_do_not_count(spark):
    rows = [("daton_x", "t", 1, "p", True), ("daton_x", "t", 2, "p", None), ("daton_x", "t", 40, "p", False)]
    assert stale(spark, rows, []) == [("daton_x", "t", 24, 40)]


def test_latest_time_over_all_projects_counts(spark):
    rows = [("daton_x", "t", 99, "b"), ("daton_x", "t", 30, "a"), ("daton_x", "t", 60, "a")]
    (row,) = td.evaluate(activity(spark, *rows), thresholds(spark), as_of=NOW).collect()
    assert (row.hours_since_last_update, row.present_in_projects) == (30, ["a", "b"])


def test_ignore_lists(spark):
    rows = [("daton_x", "t", 99), ("daton_x", "u", 99), ("daton_y", "t", 99), ("daton_y", "u", 99)]
    datasets = spark.createDataFrame([("daton_y",), ("daton_y",), (None,)], "schema_name string")
    tables = spark.createDataFrame([("daton_x", "u"), (None, "t")], "table_schema string, table_name string")
    found = stale(spark, rows, [], ignored_datasets=datasets, ignored_tables=tables)
    assert [r[:2] for r in found] == [("daton_x", "t")]


def test_dataset_label_ignores_the_name_in_all_projects(spark):
    rows = [("daton_x", "t", 99, "p"), ("daton_x", "t", 99, "q")]
    datasets = spark.createDataFrame([("daton_x",)], "schema_name string")
    assert stale(spark, rows, [], ignored_datasets=datasets) == []


def test_tables_younger_than_every_threshold_are_left_out_early(spark):
    rows = [("daton_x", f"t{i}", i) for i in range(60)]
    rules = [("t%", 40), ("%1", 3), ("t2_", None)]
    found = {r[1]: r[2] for r in stale(spark, rows, rules)}
    expected = {}
    for i in range(60):
        violated = [h for fits, h in ((True, 40), (f"t{i}".endswith("1"), 3)) if fits and i > h]
        if violated:
            expected[f"t{i}"] = 40 if i > 40 else 3
    # both patterns are two characters long; the text order settles the tie
    expected.update({f"t{i}": 3 for i in (51, 41) })
    assert found == expected


def test_threshold_must_be_whole_hours(spark):
    rules = spark.createDataFrame([("t", 1.5)], "table_pattern string, latency_threshold double")
    with pytest.raises(TypeError):
        td.evaluate(activity(spark, ("daton_x", "t", 9)), rules, as_of=NOW)


@pytest.mark.parametrize("zone", ["America/New_York", "Australia/Lord_Howe"])
def test_session_zone_does_not_matter(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    ages = [24.0, 24.25, 24 * 325.5, 24 * 90 + 0.5]
    rows = activity(spark, *[("daton_x", f"t{i}", age) for i, age in enumerate(ages)])
    instants = rows.withColumn(
        "storage_last_modified_time",
        F.timestamp_micros(
            F.expr(
                "cast(extract(SECOND FROM (storage_last_modified_time - TIMESTAMP_NTZ '1970-01-01')) * 1000000 AS bigint)"
                " + 60000000 * (cast(cast(storage_last_modified_time - TIMESTAMP_NTZ '1970-01-01' AS interval minute) AS bigint))"
            )
        ),
    )
    text = F.col("last_update").cast("string")
    for given, as_of in ((rows, NOW), (instants, NOW.replace(tzinfo=timezone.utc))):
        found = td.evaluate(given, thresholds(spark), as_of=as_of)
        got = {
            r.table_name: (r.text, r.hours_since_last_update)
            for r in found.withColumn("text", text).collect()
        }
        assert got == {
            f"t{i}": (str(NOW - timedelta(hours=age) + timedelta(hours=5.5)), int(age))
            for i, age in enumerate(ages)
            if age > 24
        }


def test_as_of_defaults_to_now(spark):
    fresh = spark.range(1).select(
        F.lit("p").alias("source_project_id"),
        F.lit("daton_x").alias("table_schema"),
        F.explode(F.array(F.lit(23), F.lit(25))).alias("age"),
        F.lit(False).alias("deleted"),
    ).select(
        "*",
        F.concat(F.lit("t"), "age").alias("table_name"),
        (F.current_timestamp() - F.expr("INTERVAL '1' HOUR") * F.col("age")).alias("storage_last_modified_time"),
    )
    assert [r.table_name for r in td.evaluate(fresh, thresholds(spark)).collect()] == ["t25"]


def test_empty_scope_restricts_nothing(spark):
    assert td.live_tables(activity(spark, ("anything", "t", 1)), Scope()).count() == 1


def test_a_long_list_gives_the_same_tables_without_sorting_all_matches(spark):
    """One number a table is kept while patterns are met, in a hash aggregate; no row for each match is sorted."""
    rules = [("a%", 1), ("abc%", 3), ("ab%", 2), ("%bc", 9), ("%abc", 7), ("abc%", 4), ("%", 100), ("_", 5), ("b%", 500), (None, 1), ("x%", None)]
    rows = [(d, t, age) for d in ("d_prod_raw", "daton_x") for t in ("abc", "ABC", "a", "b", "xyz", "") for age in (2.5, 8, 48)]
    rows += [("daton_x", None, 48), ("daton_x", "only_b", 48)]
    for some in (rules, [("b%", 500), ("zz%", 1)], []):
        short, long = (stale(spark, rows, some, nested_loop_rules=n) for n in (64, -1))
        assert short == long and short
    found = td.evaluate(activity(spark, *rows), thresholds(spark, *rules), as_of=NOW, nested_loop_rules=0)
    text = found._jdf.queryExecution().executedPlan().toString()
    matches = [line for line in text.splitlines() if "partial_min(" in line and "_rank" in line]
    assert matches and all("HashAggregate" in line and "Object" not in line for line in matches)
    windows = text[: text.index("partial_min(")].count("WindowGroupLimit")
    assert windows and "WindowGroupLimit" not in text[text.index("partial_min("):]
