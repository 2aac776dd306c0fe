"""Byte repeats against a count of all windows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.repeats import without_repeats

LENGTH = 200


def brute_force(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + LENGTH] for b in raw for k in range(len(b) - LENGTH + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - LENGTH + 1):
            if seen[b[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = b"\1" * LENGTH
        runs = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long = prose(90), prose(4000)
    near = prose(200).split(" ")
    out = [None, "", "short", "a" * 199, "b" * 200, "b" * 200, "c" * 700, "ab" * 400, long, long[3000:9000] + prose(10)]
    out += [prose(rng.randint(5, 60)) + passage + prose(rng.randint(5, 60)) for _ in range(12)]
    for _ in range(10):
        copy = list(near)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    return out + [out[-1], prose(100)]


@pytest.mark.parametrize("most", [20_000, 1])
def test_equals_brute_force(spark, tmp_path, most, monkeypatch):
    from tidemark.llm import repeats

    whole = repeats.repeated_spans
    monkeypatch.setattr(repeats, "repeated_spans", lambda d, f, n: whole(d, f, n, most))
    given = texts()
    rows = spark.createDataFrame(list(enumerate(given)), "doc_id bigint, text string")
    rows = rows.withColumn("h", F.lit(1)).withColumn("th", F.lit("x")).repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in without_repeats(rows, str(tmp_path)).collect()}
    assert got == dict(enumerate(brute_force(given)))


def test_repeated_rows_ids_and_null_ids(spark, tmp_path):
    a, b = "x y " * 60, "".join(map(chr, range(97, 123))) * 10
    rows = [(1, a), (1, a), (2, b), (None, b), (3, b[:100]), (2, "only one " + "q" * 50)]
    found = without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path)).collect()
    expected = Counter((i, *x) for (i, _), x in zip(rows, brute_force([t for _, t in rows]), strict=True))
    assert Counter(map(tuple, found)) == expected


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert without_repeats(none, str(tmp_path)).collect() == []
