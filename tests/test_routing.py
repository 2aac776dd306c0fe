"""Which record goes where."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import tidemark as td

TEXT = '{"acme": "C1", "daton|acme": "C1,C1", "nexus": "C2", "^Acme": "C3,C1", "z": "C1,C3", "d$": "D0", "default": "D0"}'


def routes(spark, names, column="table_schema", **options):
    records = spark.createDataFrame([(n,) for n in names], f"{column} string")
    routed = td.route(records, td.rules_from_json(spark, TEXT), **options)
    return Counter((r[column], r.route) for r in routed.collect())


@pytest.mark.parametrize("nested_loop_rules", [64, 3, 1, 0])
def test_routes(spark, nested_loop_rules):
    names = ["daton_acme", "nexus", "AcmeZ", "zz", "d", "none", "", None]
    found = routes(spark, names, nested_loop_rules=nested_loop_rules)
    expected = Counter({(name, "default:D0"): 1 for name in names})
    expected.update({("daton_acme", "match:C1"): 2, ("nexus", "match:C2"): 1, ("AcmeZ", "match:C3,C1"): 1})
    # the same channels in another order, and the default's channels, are routes of their own
    expected.update({("zz", "match:C1,C3"): 1, ("d", "match:D0"): 1})
    assert found == expected


@pytest.mark.parametrize("nested_loop_rules", [64, 3, 1, 0])
def test_dedupe_lists_a_record_once_per_route(spark, nested_loop_rules):
    found = routes(spark, ["daton_acme", "daton_acme"], dedupe=True, nested_loop_rules=nested_loop_rules)
    assert found == {("daton_acme", "default:D0"): 2, ("daton_acme", "match:C1"): 2}


def test_first_id_that_is_not_null_wins_even_if_empty(spark):
    records = spark.createDataFrame(
        [(None, "", "nexus"), (None, None, "nexus"), (5, "nexus", None)],
        "dataset_id int, dataset string, table_schema string",
    )
    got = [r[0] for r in records.select(td.dataset_id(records)).collect()]
    assert got == ["", "nexus", "5"]
    routed = td.route(records, td.rules_from_json(spark, TEXT))
    assert routed.filter("not is_default").count() == 1


def test_no_id_column_at_all(spark):
    assert routes(spark, ["acme"], column="other") == {("acme", "default:D0"): 1}


def test_fallback_channels_stand_in_for_a_missing_default(spark):
    rules = td.rules_from_json(spark, TEXT)
    records = spark.createDataFrame([("acme",)], "table_schema string")
    without = rules.filter(~F.col("is_default"))
    got = td.route(records, without, fallback_channels=["F1", "F2"])
    assert {r.route for r in got.collect()} == {"default:F1,F2", "match:C1"}
    got = td.route(records, rules, fallback_channels=["F1"])
    assert {r.route for r in got.collect()} == {"default:D0", "match:C1"}


def test_route_summary(spark):
    rules = td.rules_from_json(spark, TEXT)
    records = spark.createDataFrame([("acme",), ("acme",), ("nexus",)], "table_schema string")
    found = {r.route: r for r in td.route_summary(td.route(records, rules), rules).collect()}
    assert {k: (r.channels, r.violations, r.template) for k, r in found.items()} == {
        "default:D0": (["D0"], 3, "latency_report_success"),
        "match:C1": (["C1"], 4, "latency_report_success"),
        "match:C2": (["C2"], 1, "latency_report_success"),
    }
    assert found["match:C2"].summary_text == (
        "Found 1 table violations across 1 datasets:\n• *nexus*: 1 tables violate threshold"
    )


def test_nothing_stale_leaves_the_default_route_all_clear(spark):
    rules = td.rules_from_json(spark, TEXT)
    records = spark.createDataFrame([], "table_schema string")
    (row,) = td.route_summary(td.route(records, rules), rules).collect()
    assert (row.route, row.violations, row.template) == ("default:D0", 0, "latency_report_no_violations")
    assert row.summary_text.startswith("✅ No latency violations")


@pytest.mark.parametrize("nested_loop_rules", [64, 1, 0])
def test_all_defaults_apply(spark, nested_loop_rules):
    rules = spark.createDataFrame(
        [(1, "acme", ["A"], False), (2, None, ["D1"], True), (3, None, ["D2"], True)],
        "rule_no int, pattern string, channels array<string>, is_default boolean",
    )
    records = spark.createDataFrame([("acme",), ("other",)], "table_schema string")
    got = Counter((r.table_schema, r.route) for r in td.route(records, rules, nested_loop_rules=nested_loop_rules).collect())
    assert got == {
        ("acme", "match:A"): 1, ("acme", "default:D1"): 1, ("acme", "default:D2"): 1,
        ("other", "default:D1"): 1, ("other", "default:D2"): 1,
    }


def test_no_default_and_no_fallback_is_an_error(spark):
    rules = td.rules_from_json(spark, TEXT).filter(~F.col("is_default"))
    records = spark.createDataFrame([("acme",)], "table_schema string")
    with pytest.raises(ValueError, match="default"):
        td.route(records, rules)


def test_very_many_rules_of_one_route_are_counted_not_collected(spark):
    """An id that thousands of rules find is one row with a count while it is shuffled; its records get every route."""
    rules = spark.range(2300).selectExpr(
        "cast(id AS int) + 1 AS rule_no",
        "CASE WHEN id % 2 = 0 THEN 'acme' WHEN id % 3 = 0 THEN concat('m', id % 10, '|e') ELSE concat('none', id) END AS pattern",
        "array(if(id % 7 = 0, 'C2', 'C1')) AS channels",
        "false AS is_default",
    )
    defaults = spark.createDataFrame([(0, None, ["D"], True), (0, None, ["D"], True), (0, None, ["E"], True)], rules.schema)
    records = spark.createDataFrame([("acme",), ("acme",), ("zz",), ("",), (None,)], "table_schema string")
    routed = td.route(records, rules.unionByName(defaults), nested_loop_rules=0)
    hits = [i for i in range(2300) if i % 2 == 0 or i % 3 == 0]
    c2 = sum(i % 7 == 0 for i in hits)
    expected = Counter({("acme", "match:C1"): 2 * (len(hits) - c2), ("acme", "match:C2"): 2 * c2})
    for name, n in (("acme", 2), ("zz", 1), ("", 1), (None, 1)):
        expected.update({(name, "default:D"): 2 * n, (name, "default:E"): n})
    assert Counter(map(tuple, routed.select("table_schema", "route").collect())) == expected
    deduped = td.route(records, rules.unionByName(defaults), dedupe=True, nested_loop_rules=0)
    assert Counter(map(tuple, deduped.select("table_schema", "route").collect())) == {
        key: 2 if key[0] == "acme" else 1 for key in expected
    }
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "collect_list" in line and "_id" in line]
    assert "SortMergeJoin [pattern" not in plan
