"""Collecting activity, storing and reading tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tidemark as td
from tidemark.sources.schemas import ACTIVITY, IGNORED_DATASETS, OPTIONS, THRESHOLDS, conform

OWN = "table_schema string, table_name string, storage_last_modified_time timestamp, deleted boolean"


@pytest.fixture
def region(spark):
    def make(*names):
        return spark.createDataFrame([("d", n, datetime(2024, 1, 1), False) for n in names], OWN)

    return make


def test_union_tags_projects_and_skips_what_is_missing(spark, region, tmp_path):
    stored = str(tmp_path / "region")
    td.replace_table(region("c"), stored)
    reordered = region("a", "b").select("deleted", "table_name", "table_schema", "storage_last_modified_time")
    sources = {"p": [reordered, str(tmp_path / "none")], "q": stored, "r": "no_such_table"}
    found = td.union_sources(spark, sources)
    assert found.columns == ACTIVITY.fieldNames()
    assert {(r.source_project_id, r.table_name) for r in found.collect()} == {("p", "a"), ("p", "b"), ("q", "c")}
    with pytest.raises(FileNotFoundError):
        td.union_sources(spark, sources, on_missing="error")


def test_other_errors_are_not_skipped(spark, tmp_path):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        td.union_sources(spark, {"p": str(path)}).collect()


def test_no_source_left(spark):
    empty = td.union_sources(spark, {"p": "no_such_table"})
    assert empty.columns == ACTIVITY.fieldNames() and empty.isEmpty()
    with pytest.raises(RuntimeError):
        td.require_rows(empty, "table activity")


def test_columns_match_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2.5)], "t string, v double")
    assert [tuple(r) for r in td.union_frames([a, b]).collect()] == [(1, "x", None), (None, "y", 2.5)]


def test_conform(spark, region):
    given = region("a").withColumn("extra", F.lit(1)).withColumn("source_project_id", F.lit("p"))
    assert conform(given, ACTIVITY).columns == ACTIVITY.fieldNames()
    with pytest.raises(TypeError, match="missing"):
        conform(given.drop("deleted"), ACTIVITY)
    with pytest.raises(TypeError, match="deleted is string"):
        conform(given.withColumn("deleted", F.lit("no")), ACTIVITY)
    wide = spark.createDataFrame([("a", 1)], "table_pattern string, latency_threshold long")
    assert conform(wide, THRESHOLDS).schema["latency_threshold"].dataType.simpleString() == "bigint"


def test_read_source(spark, tmp_path):
    rules = spark.createDataFrame([("a", 1, "x")], "table_pattern string, latency_threshold int, extra string")
    td.replace_table(rules, str(tmp_path / "rules"))
    assert tuple(td.read_source(spark, str(tmp_path / "rules"), THRESHOLDS).first()) == ("a", 1)
    with pytest.raises(FileNotFoundError):
        td.read_source(spark, str(tmp_path / "none"), THRESHOLDS)
    with pytest.raises(TypeError):
        td.read_source(spark, rules, OPTIONS)


def test_opt_out_needs_the_label_and_the_blank(spark):
    rows = [
        ("yes", "labels", '[STRUCT("latency_check_ignore", "true")]'),
        ("yes", "labels", '[STRUCT("a", "b"), STRUCT("latency_check_ignore", "true")]'),
        ("wild", "labels", '"latencyXcheckYignore", "true"'),
        ("no_blank", "labels", '"latency_check_ignore","true"'),
        ("false", "labels", '"latency_check_ignore", "false"'),
        ("option", "description", '"latency_check_ignore", "true"'),
        ("null", "labels", None),
    ]
    found = td.opt_out_datasets(spark.createDataFrame(rows, OPTIONS))
    assert sorted(r.schema_name for r in found.collect()) == ["wild", "yes"]


def test_table_activity_keeps_deleted_rows_apart(spark):
    rows = spark.createDataFrame([("p", "d", "t", 1, True), ("p", "d", "t", 2, False), ("p", "d", "t", 3, True)],
                                 "a string, b string, c string, n int, gone boolean")
    columns = (F.col("a"), F.col("b"), F.col("c"), F.timestamp_seconds("n"))
    found = td.table_activity(rows, *columns, F.col("gone")).collect()
    assert sorted((r.deleted, r.storage_last_modified_time.second) for r in found) == [(False, 2), (True, 3)]
    (row,) = td.table_activity(rows, *columns).collect()
    assert (row.deleted, row.storage_last_modified_time.second) == (False, 3)


def test_file_activity(spark, tmp_path):
    """A folder that Spark wrote is one table, however many files and partitions; a single file is one, too."""
    import os

    folder = str(tmp_path / "sales/orders")
    spark.range(100).repartition(4).write.parquet(folder)
    spark.range(10).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(str(tmp_path / "sales/items"))
    (part,) = [p for p in (tmp_path / "sales/orders").glob("part-*")][:1]
    single = tmp_path / "sales/single.parquet"
    single.write_bytes(part.read_bytes())
    for i, path in enumerate(sorted(tmp_path.rglob("*.parquet"))):
        if path.is_file():
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    newest = max(int(p.stat().st_mtime) for p in (tmp_path / "sales/orders").glob("part-*"))
    found = td.file_activity(spark, [str(tmp_path / "sales")], "p")
    got = {(r.source_project_id, r.table_schema, r.table_name, r.deleted): r.s for r in found.withColumn("s", F.unix_seconds("storage_last_modified_time")).collect()}
    assert set(got) == {("p", "sales", name, False) for name in ("orders", "items", "single")}
    assert got["p", "sales", "orders", False] == newest
    # and it is a source like any other
    own = found.drop("source_project_id")
    assert td.union_sources(spark, {"p": own}).count() == 3


def test_an_existing_folder_without_files_has_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    got = td.union_sources(spark, {"p": str(tmp_path / "empty")})
    assert got.isEmpty() and "deleted" in got.columns


def test_replace_and_read_back(spark, region, tmp_path):
    for target in (str(tmp_path / "t"), "stored_table"):
        td.replace_table(region("a", "b"), target)
        td.replace_table(region("c"), target)
        assert [r.table_name for r in td.read_table(spark, target).collect()] == ["c"]
    spark.sql("DROP TABLE stored_table")


def test_empty_table_keeps_its_columns(spark, tmp_path):
    td.replace_table(spark.createDataFrame([], IGNORED_DATASETS), str(tmp_path / "labels"))
    stored = td.read_table(spark, str(tmp_path / "labels"))
    assert stored.columns == ["schema_name"] and stored.isEmpty()


def test_violations_are_sorted_on_read(spark, tmp_path):
    rows = [("b", "t", 5), ("a", "t", 5), ("c", "t", 9)]
    df = spark.createDataFrame(rows, "table_schema string, table_name string, hours_since_last_update long")
    td.replace_table(df, str(tmp_path / "v"))
    assert [r.table_schema for r in td.read_violations(spark, str(tmp_path / "v")).collect()] == ["c", "a", "b"]


def test_row_counts(spark, region):
    counts = td.row_counts({"one": region("a"), "two": region("a", "b")})
    assert {tuple(r) for r in counts.collect()} == {("one", 1), ("two", 2)}


def test_scratch_folder_is_where_the_cluster_says(spark, conf):
    one, two = td.scratch_folder(spark), td.scratch_folder(spark)
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_empty_files_count(spark, tmp_path):
    """A file's time counts whatever the file holds."""
    import os

    full, empty = str(tmp_path / "lake/full"), str(tmp_path / "lake/empty")
    spark.range(10).repartition(1).write.parquet(full)
    spark.range(0).write.parquet(empty)
    (part,) = (tmp_path / "lake/full").glob("part-*")
    (blank,) = (tmp_path / "lake/empty").glob("part-*")
    newest = tmp_path / "lake/full/part-99999.parquet"
    newest.write_bytes(blank.read_bytes())
    for path, seconds in ((part, 1_600_000_000), (newest, 1_700_000_000), (blank, 1_650_000_000)):
        os.utime(path, (seconds, seconds))
    found = td.file_activity(spark, [str(tmp_path / "lake")], "p").withColumn("s", F.unix_seconds("storage_last_modified_time"))
    assert {(r.table_name, r.s) for r in found.collect()} == {("full", 1_700_000_000), ("empty", 1_650_000_000)}
    files = td.listed_files(spark, [str(tmp_path / "lake")]).join(td.rows_per_file(spark, [str(tmp_path / "lake")]), "file")
    assert sorted((r.table_name, r.row_count) for r in files.collect()) == [("empty", 0), ("full", 0), ("full", 10)]


def test_file_times_need_no_rows(spark, sf_dir):
    plan = td.file_activity(spark, [f"{sf_dir}/lineitem.parquet"], "p")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "Parquet" not in plan


def broken(df):
    return df.withColumn("table_name", F.expr("if(table_name = 'b', raise_error('broken'), table_name)"))


def test_a_write_that_fails_leaves_the_old_rows(spark, region, tmp_path):
    for target in (str(tmp_path / "t"), "kept_table"):
        assert td.replace_table(region("a", "x"), target) == 2
        with pytest.raises(Exception, match="broken"):
            td.replace_table(broken(region("a", "b", "c")), target)
        assert {r.table_name for r in td.read_table(spark, target).collect()} == {"a", "x"}
        assert td.replace_table(region("c"), target) == 1
        assert [r.table_name for r in td.read_table(spark, target).collect()] == ["c"]
    spark.sql("DROP TABLE kept_table")
    assert td.union_sources(spark, {"p": str(tmp_path / "t")}).count() == 1


def test_a_reader_keeps_its_version(spark, region, tmp_path):
    target = str(tmp_path / "t")
    td.replace_table(region("a"), target)
    before = td.read_table(spark, target)
    td.replace_table(before.unionByName(region("b")), target)  # a table may be replaced by what is read from it
    assert [r.table_name for r in before.collect()] == ["a"]
    for _ in range(3):
        td.replace_table(td.read_table(spark, target), target)
    assert td.read_table(spark, target).count() == 2
    assert len(list((tmp_path / "t").glob("_v*"))) == 2, "older versions are removed"


def test_other_columns_replace_a_table(spark, region):
    td.replace_table(region("a"), "changed_table")
    td.replace_table(spark.range(3), "changed_table")
    assert spark.table("changed_table").columns == ["id"] and spark.table("changed_table").count() == 3
    spark.sql("DROP TABLE changed_table")


def test_sources_may_lack_columns(spark, region):
    with pytest.warns(UserWarning, match="a source of p has no deleted"):
        found = td.union_sources(spark, {"p": [region("a").drop("deleted"), region("b")]})
    assert {(r.table_name, r.deleted) for r in found.collect()} == {("a", None), ("b", False)}
    with pytest.raises(TypeError, match="missing"):
        td.union_sources(spark, {"p": region("a").drop("table_name")})
