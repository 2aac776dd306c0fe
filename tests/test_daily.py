"""The daily run, step by step."""

from pathlib import Path

import pytest

from tidemark.plans import daily
from tidemark.plans import fixtures as fx
from tidemark.sources.schemas import OPTIONS


@pytest.fixture
def work(tmp_path):
    return daily.Workspace(str(tmp_path))


def folded(rows):
    """One row per table and mark is what is staged."""
    return rows.select("table_schema", "table_name", "deleted").distinct().count()


@pytest.fixture
def rows(spark):
    return fx.relation(spark, "/root/testdata/sf0.001", fx.ACTIVITY).drop("source_project_id")


def check(spark, work, **options):
    sf_dir = "/root/testdata/sf0.001"
    histories = [fx.relation(spark, sf_dir, d) for d in (fx.SOURCE_TABLES, fx.SOURCES, fx.JOB_STATS)]
    ignored = fx.relation(spark, sf_dir, fx.IGNORED_TABLES)
    settings = {"as_of": fx.AS_OF, "runtime": "batch_runtime", "tiebreak": ["event_id"], **options}
    return daily.check(spark, work, fx.thresholds(spark), ignored, *histories, **settings)


def test_collect_counts_what_it_stored(spark, work, rows):
    counts = daily.collect(spark, work, {"p": rows, "q": [rows, "no_such_table"]}, {"p": fx.options(spark)})
    assert {tuple(r) for r in counts.collect()} == {
        ("table_storage_rows", 2 * folded(rows)), ("dataset_labels_rows", 1),
    }


def test_no_activity_is_an_error_and_replaces_nothing(spark, work, rows):
    daily.collect(spark, work, {"p": rows}, {})
    with pytest.raises(RuntimeError):
        daily.collect(spark, work, {"p": rows.limit(0)}, {})
    assert spark.read.parquet(work.activity).count() == folded(rows)


def test_no_options_at_all_store_an_empty_list(spark, work, rows):
    counts = daily.collect(spark, work, {"p": rows}, {"p": "no_such_table"})
    assert counts.filter("input = 'dataset_labels_rows'").first().row_count == 0
    assert spark.read.parquet(work.opted_out).columns == ["schema_name"]


def test_whole_run_and_reports(spark, work, rows):
    daily.collect(spark, work, {"p": rows}, {"p": spark.createDataFrame([], OPTIONS)})
    violations = check(spark, work)
    hours = [r.hours_since_last_update for r in violations.collect()]
    assert hours and hours == sorted(hours, reverse=True)
    summary = {r.route: r.violations for r in daily.publish(spark, work, fx.ROUTING).collect()}
    assert summary["default:C0"] == len(hours)
    folders = list(Path(work.report).glob("route=*"))
    assert len(folders) == len(summary)
    # a second run replaces everything
    assert check(spark, work).count() == len(hours)


def test_nothing_stale(spark, work, rows):
    daily.collect(spark, work, {"p": rows}, {})
    assert check(spark, work, as_of="2023-01-01 00:00:00").isEmpty()
    (row,) = daily.publish(spark, work, fx.ROUTING).collect()
    assert (row.violations, row.template) == (0, "latency_report_no_violations")
    assert spark.read.parquet(work.report).columns == ["message"]
