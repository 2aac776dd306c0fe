"""Activity kept up to date from new files."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import tidemark as td
from tidemark.sources.schemas import ACTIVITY

DAY = datetime(2024, 1, 1)


def batch(spark, *rows):
    own = [("p", "d", name, DAY + timedelta(hours=hours), gone) for name, hours, gone in rows]
    return spark.createDataFrame(own, "source_project_id string, table_schema string, table_name string, storage_last_modified_time timestamp, deleted boolean")


def state_of(frame):
    rows = frame.select("table_name", "deleted", "storage_last_modified_time").collect()
    return {(n, gone): (t - DAY) // timedelta(hours=1) for n, gone, t in rows}


def test_two_batches_equal_one(spark, tmp_path):
    lake, state = str(tmp_path / "lake of days"), str(tmp_path / "state")
    one = batch(spark, ("a", 1, False), ("a", 5, False), ("b", 2, True))
    two = batch(spark, ("a", 3, False), ("b", 1, False), ("c", 7, False))
    one.repartition(2).write.parquet(lake)
    assert td.activity_state(spark, state).isEmpty()
    found = td.fold_new_files(spark, [lake], state, lambda rows: rows)
    assert state_of(found) == {("a", False): 5, ("b", True): 2}
    two.write.mode("append").parquet(lake)
    found = td.fold_new_files(spark, [lake], state, lambda rows: rows)
    assert state_of(found) == {("a", False): 5, ("b", True): 2, ("b", False): 1, ("c", False): 7}
    other = td.fold_new_files(spark, [lake], str(tmp_path / "both"), lambda rows: rows)
    assert state_of(other) == state_of(found) and found.columns == ACTIVITY.fieldNames()


def test_a_day_reads_its_own_files_only(spark, tmp_path):
    lake, state = tmp_path / "lake", str(tmp_path / "state")
    batch(spark, ("a", 1, False)).coalesce(1).write.parquet(str(lake))
    td.fold_new_files(spark, [str(lake)], state, lambda rows: rows)
    assert td.unseen_files(spark, [str(lake)], state).isEmpty()
    (old,) = lake.glob("part-*")
    seen = os.stat(old)
    old.write_bytes(b"x" * seen.st_size)  # no Parquet any more, but the same length and time
    os.utime(old, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    batch(spark, ("b", 2, False)).repartition(3).write.mode("append").parquet(str(lake))
    new = {p.name for p in lake.glob("part-*")} - {old.name}
    assert {r.path.rpartition("/")[2] for r in td.unseen_files(spark, [str(lake)], state).collect()} == new
    read = []
    found = td.fold_new_files(spark, [str(lake)], state, lambda rows: read.append(rows.inputFiles()) or rows)
    assert {x.rpartition("/")[2] for x in read[0]} == new
    assert state_of(found) == {("a", False): 1, ("b", False): 2}
    assert state_of(td.fold_new_files(spark, [str(lake)], state, lambda rows: 1 / 0)) == state_of(found), "nothing new, nothing read"


def test_changed_files_are_read_again(spark, tmp_path):
    lake, state = tmp_path / "lake", str(tmp_path / "state")
    batch(spark, ("a", 1, False)).coalesce(1).write.parquet(str(lake))
    td.fold_new_files(spark, [str(lake)], state, lambda rows: rows)
    (old,) = lake.glob("part-*")
    batch(spark, ("a", 9, False), ("b", 4, False)).coalesce(1).write.parquet(str(tmp_path / "other"))
    (new,) = (tmp_path / "other").glob("part-*")
    old.write_bytes(new.read_bytes())
    (lake / f".{old.name}.crc").unlink()
    assert state_of(td.fold_new_files(spark, [str(lake)], state, lambda rows: rows)) == {("a", False): 9, ("b", False): 4}
    assert td.read_table(spark, f"{state}/files").count() == 1


def test_a_fold_that_fails_changes_nothing(spark, tmp_path):
    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    batch(spark, ("a", 1, False)).write.parquet(lake)
    td.fold_new_files(spark, [lake], state, lambda rows: rows)
    batch(spark, ("b", 2, False)).write.mode("append").parquet(lake)
    broken = F.expr("if(table_name = 'b', raise_error('broken'), table_name)")
    with pytest.raises(Exception, match="broken"):
        td.fold_new_files(spark, [lake], state, lambda rows: rows.withColumn("table_name", broken))
    assert state_of(td.activity_state(spark, state)) == {("a", False): 1}
    assert state_of(td.fold_new_files(spark, [lake], state, lambda rows: rows)) == {("a", False): 1, ("b", False): 2}
