"""Job facts and the report."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tidemark as td

DAY = [datetime(2024, 1, d) for d in range(1, 10)]
TABLES = (
    "tableid long, sourceid long, companyid long, status int, tablename string, selected boolean, "
    "_daton_batch_runtime timestamp_ntz"
)
SOURCES = "sourceid long, companyid long, type string, status int, name string, _daton_batch_runtime timestamp_ntz"
STATS = (
    "tableid long, sourceid long, tablename string, lasterrorcode int, lasterror string, "
    "lastendtime string, _daton_batch_runtime timestamp_ntz"
)


def tables(spark, *rows):
    return spark.createDataFrame(list(rows), TABLES)


def sources(spark, *rows):
    return spark.createDataFrame(list(rows), SOURCES)


def stats(spark, *rows):
    return spark.createDataFrame(list(rows), STATS)


def test_filter_comes_before_latest(spark):
    history = tables(
        spark,
        (1, 1, 1, 2, "old_active", True, DAY[0]),
        (1, 1, 1, 6, "new_paused", True, DAY[5]),
        (2, 1, 1, 2, "unselected", False, DAY[0]),
        (3, 1, 1, 2, "null_selected", None, DAY[0]),
        (4, 1, 1, 2, "first", True, DAY[0]),
        (4, 1, 1, 2, "second", True, DAY[1]),
    )
    found = sorted(r.tablename for r in td.latest_source_tables(history).collect())
    assert found == ["old_active", "second"]


def test_status_names_and_latest_source(spark):
    rows = [(i, 1, "t", status, "n", DAY[0]) for i, status in enumerate([2, 11, 6, 5, 7, None])]
    rows.append((0, 1, "t", 5, "renamed", DAY[3]))
    found = {r.sourceid: (r.status, r.name) for r in td.latest_sources(sources(spark, *rows)).collect()}
    assert found == {
        0: ("Deleted", "renamed"), 1: ("Rescheduled", "n"), 2: ("Paused", "n"), 3: ("Deleted", "n"),
        4: ("Unknown", "n"), 5: ("Unknown", "n"),
    }


def test_job_end_time(spark):
    rows = [
        (1, 1, "a", 0, None, "1704067200123", DAY[0]),
        (2, 1, "b", 0, None, "not a number", DAY[0]),
        (3, 1, "c", 0, None, None, DAY[0]),
    ]
    found = {r.tableid: r.last_job_end_time for r in td.latest_job_stats(stats(spark, *rows)).collect()}
    assert found == {1: datetime(2024, 1, 1, 5, 30, 0, 123000), 2: None, 3: None}


def test_job_end_time_from_other_types(spark):
    base = stats(spark, (1, 1, "a", 0, None, "0", DAY[0]))
    for value in ("1704067200122.6D", "1704067200123L", "1704067200122.5BD"):
        (row,) = td.latest_job_stats(base.withColumn("lastendtime", F.expr(value))).collect()
        assert row.last_job_end_time == datetime(2024, 1, 1, 5, 30, 0, 123000)


def test_tiebreak(spark):
    rows = [(1, 1, 1, 2, f"t{i}", True, DAY[0]) for i in range(5)]
    (row,) = td.latest_source_tables(tables(spark, *rows), tiebreak=["tablename"]).collect()
    assert row.tablename == "t4"


@pytest.fixture
def histories(spark):
    return (
        tables(spark, (1, 1, 9, 2, "orders", True, DAY[0]), (1, 2, 9, 2, "items", True, DAY[0]),
               (5, 3, 9, 2, "lost", True, DAY[0])),
        sources(spark, (1, 9, "shop", 2, "acme", DAY[0]), (2, 9, "ads", 6, "beta", DAY[0])),
        stats(spark, (1, 1, "orders", 10, "e1", "0", DAY[0]), (1, 2, "items", 20, "e2", "0", DAY[0])),
    )


def test_table_id_alone_multiplies_rows(histories):
    facts = td.enrichment(*histories).collect()
    assert sorted((r.table_name or "", r.lasterrorcode or 0) for r in facts) == [
        ("", 0), ("acme_orders", 10), ("acme_orders", 20), ("beta_items", 10), ("beta_items", 20),
    ]


def test_strict_key_does_not(histories):
    facts = td.enrichment(*histories, strict_key=True).collect()
    assert sorted((r.table_name or "", r.lasterrorcode or 0) for r in facts) == [
        ("", 0), ("acme_orders", 10), ("beta_items", 20),
    ]


def stale(spark, *rows):
    return spark.createDataFrame(
        [(d, t, DAY[0], 24, h, ["p"]) for d, t, h in rows],
        "table_schema string, table_name string, last_update timestamp_ntz, latency_threshold int, "
        "hours_since_last_update long, present_in_projects array<string>",
    )


def test_report_joins_on_the_name_only_and_is_sorted(spark, histories):
    tables_ = stale(spark, ("d1", "acme_orders", 30), ("d2", "acme_orders", 40), ("d3", "other", 50))
    report = td.report(tables_, td.enrichment(*histories))
    assert report.columns == [
        "table_schema", "table_name", "last_update", "latency_threshold", "hours_since_last_update",
        "present_in_projects", "platform", "source_status", "lasterrorcode", "lasterror", "last_job_end_time",
    ]
    got = [(r.table_schema, r.lasterrorcode) for r in report.collect()]
    assert got[0] == ("d3", None)
    assert sorted(got[1:3]) == [("d2", 10), ("d2", 20)] and sorted(got[3:]) == [("d1", 10), ("d1", 20)]
    row = report.filter("table_schema = 'd2'").first()
    assert (row.last_update, row.last_job_end_time) == ("2024-01-01 00:00:00", "1970-01-01 05:30:00")


def test_only_for_changes_nothing_in_the_report(spark, histories):
    tables_ = stale(spark, ("d1", "acme_orders", 30), ("d3", "other", 50))
    whole = td.report(tables_, td.enrichment(*histories)).collect()
    cut = td.report(tables_, td.enrichment(*histories, only_for=tables_)).collect()
    assert sorted(whole, key=str) == sorted(cut, key=str)


def test_ties_are_settled_the_same_way_whatever_the_order(spark):
    rows = [(1, 1, i, 2, f"t{i}", True, DAY[0]) for i in range(20)]
    picked = {
        td.latest_source_tables(tables(spark, *given).repartition(n)).first().tablename
        for given in (rows, rows[::-1])
        for n in (1, 3, 8)
    }
    assert len(picked) == 1


def test_a_wrong_type_in_a_history_is_an_error(spark, sf_dir):
    from tidemark.plans import fixtures as fx

    tables, sources, stats = (fx.relation(spark, sf_dir, d) for d in (fx.SOURCE_TABLES, fx.SOURCES, fx.JOB_STATS))
    options = {"runtime": "batch_runtime", "tiebreak": ["event_id"]}
    for broken in (
        (tables.withColumn("status", F.lit("2")), sources, stats),
        (tables, sources.withColumn("name", F.lit(1)), stats),
        (tables, sources, stats.withColumn("lasterrorcode", F.lit("x"))),
    ):
        with pytest.raises(TypeError):
            td.enrichment(*broken, **options)
