"""The Jaccard join against all pairs of sets."""

import random
import re

from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.jaccard import jaccard_join


def shingles(text, width):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_force(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    links = {
        i: {j for j, b in sets.items() if i != j and a and b and 100 * len(a & b) >= percent * len(a | b)} for i, a in sets.items()
    }
    out = {}
    for i in sets:
        reach, todo = {i}, [i]
        while todo:
            todo += [j for j in links[todo.pop()] if j not in reach and not reach.add(j)]
        out[i] = (len(sets[i]), len(links[i]), min(reach))
    return out


def documents():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    common = [word() for _ in range(30)]
    out = [None, "", " \n\t", "one", "ONE", "a b c", "A  b\tc", "a b c d", "a b c d e", "w " * 3000, "é " * 50, "É " * 50]
    for size in (12, 30, 80, 200):
        base = [word() for _ in range(size)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy[: rng.choice([size, size, size - 2])]))
    out += [" ".join(common + [word() for _ in range(rng.randint(1, 60))]) for _ in range(40)]
    return list(enumerate(out))


def test_equals_brute_force(spark, tmp_path):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("class", F.lit(1)).withColumn("n", F.lit(1))
    for width, percent, chunk in ((4, 85, 128), (5, 80, 3)):
        got = jaccard_join(df.repartition(6), str(tmp_path / f"{width}"), width, percent, chunk)
        assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == brute_force(rows, width, percent)


def test_repeated_rows_and_null_ids(spark, tmp_path):
    text = "one two three four five six"
    rows = [(3, text), (3, text), (2, text), (None, text), (4, "other words here and so on")]
    found = sorted(map(tuple, jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path)).collect()), key=str)
    assert found == sorted([(3, 3, 2, 2), (3, 3, 2, 2), (2, 3, 2, 2), (None, 3, 0, None), (4, 3, 0, 4)], key=str)


def test_no_rows_and_no_words(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_join(none, str(tmp_path / "a")).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, jaccard_join(blank, str(tmp_path / "b")).collect())) == [(1, 0, 0, 1), (2, 0, 0, 2)]


def test_texts_and_chunks_reach_python_in_small_batches(spark, tmp_path, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, sizes, store = spark.conf.get(name), {}, jaccard.stored

    def noting(frame, path):
        sizes[path.rsplit("/", 1)[-1]] = int(spark.conf.get(name))
        return store(frame, path)

    monkeypatch.setattr(jaccard, "stored", noting)
    rows = [(i, f"a b c d e {i % 3}") for i in range(20)]
    jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path)).collect()
    assert max(sizes["signed"], sizes["sets"]) <= 500 and sizes["promising"] <= 16
    assert spark.conf.get(name) == before
