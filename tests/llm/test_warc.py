"""WARC archives: exact round trip, revisits, determinism."""

import base64
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.warc import read_records, read_warc, record, write_warc

SCHEMA = "page_id bigint, url string, html string"


def pages():
    rng = random.Random(1)
    text = lambda n: "".join(rng.choice("<p>abc é\r\n\0") for _ in range(n))
    same = text(300)
    rows = [(i, f"http://h.example/{i}", text(rng.randint(0, 500))) for i in range(60)]
    rows += [(100 + i, "http://copy.example/", same) for i in range(30)]
    rows += [(200, None, None), (201, "http://e.example/é\n x", ""), (202, "", "x" * 3_000_000), (None, "u", same), (None, "v", "only")]
    return rows + [(5, "http://h.example/5", rows[5][2]), (100, "http://copy.example/", same)]


def expected(rows, min_bytes=0):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        revisit = len(raw) >= min_bytes and ids and page != min(ids)
        name = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), name, "revisit" if revisit else "response", min(ids) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 100])
def test_round_trip(spark, tmp_path, min_bytes):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_shard", F.lit("x")).withColumn("_first", F.lit("y")).repartition(4)
    manifest = write_warc(df, str(tmp_path), min_bytes, shard_bytes=20_000, roll_bytes=4_000)
    assert manifest.count() > 5
    found = read_warc(spark, str(tmp_path)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(rows, min_bytes)
    whole = {(p, (h or "").encode()) for p, _, h in rows}
    assert all((r.page_id, bytes(r.payload)) in whole for r in found if r.record_type == "response")
    assert not list((tmp_path / "archives").glob(".*warc*")), "a temporary name is left"


def test_the_same_files_in_every_run(spark, tmp_path):
    rows = pages()
    def names(folder, parts):
        df = spark.createDataFrame(random.Random(parts).sample(rows, len(rows)), SCHEMA).repartition(parts)
        return sorted(map(tuple, write_warc(df, str(tmp_path / folder), shard_bytes=20_000, roll_bytes=4_000).collect()))
    assert names("a", 2) == names("b", 7)


def test_leftovers_are_not_read_and_damage_is_found(spark, tmp_path):
    write_warc(spark.createDataFrame([(1, "u", "abc")], SCHEMA), str(tmp_path))
    (tmp_path / "archives" / "shard-000009-000000.warc.gz").write_bytes(b"left by a lost task")
    assert read_warc(spark, str(tmp_path)).count() == 1
    (file,) = (tmp_path / "archives").glob("shard-000000-*")
    file.write_bytes(file.read_bytes()[:-9])
    with pytest.raises(Exception, match="manifest"):
        read_warc(spark, str(tmp_path)).collect()


def test_no_pages(spark, tmp_path):
    write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path))
    assert read_warc(spark, str(tmp_path)).collect() == []


def test_record_digest_is_checked():
    import gzip

    raw = record(1, "u", b"payload", None, False)
    assert [b for _, b in read_records(io.BytesIO(gzip.compress(raw) * 2))][0].endswith(b"payload")
    with pytest.raises(ValueError, match="digest"):
        list(read_records(io.BytesIO(gzip.compress(raw.replace(b"payload", b"PAYLOAD")))))
