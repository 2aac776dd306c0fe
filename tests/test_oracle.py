"""Every query against DuckDB on the same files, compared as multisets."""

import pytest
from compare import oracle, oracle_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.workload import ENTRIES

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, sf_dir, db, name):
    names, rows = spark_rows(queries()[name](spark, sf_dir))
    assert rows
    if name in ORACLE:
        oracle_names, expected = oracle_rows(db, ORACLE[name])
        assert names == oracle_names
        assert rows == expected


def test_entry(spark):
    assert entry(spark).count() == 17


@pytest.mark.parametrize(
    "scale, report_rows, stale", [("sf0.001", 85, 17), ("sf0.01", 1290, 266), ("sf0.1", 13025, 2689)]
)
def test_known_counts(spark, scale, report_rows, stale):
    report = queries()["full_report"](spark, f"/root/testdata/{scale}").cache()
    assert report.count() == report_rows
    assert report.select("table_schema", "table_name").distinct().count() == stale
    report.unpersist()
