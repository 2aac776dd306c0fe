"""Line dedup against a plain version of the same rules."""

import random
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.linededup import _solid, patience, without_lines

SCHEMA = "doc_id bigint, text string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_pairs_are_a_common_subsequence(a, b):
    pairs = patience(a, b)
    assert all(a[x] == b[y] for x, y in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    if a == b:
        assert len(pairs) == len(a)


def brute_force(rows, rare):
    lines = {i: t.split("\n") for i, t in rows if t is not None}
    sets = {i: {x for x in own if x.strip(" ")} for i, own in lines.items()}
    holders = defaultdict(list)
    for i in sorted(sets):
        for x in sets[i]:
            holders[x].append(i)
    out = {}
    for i, own in lines.items():
        shared = {x: holders[x] for x in sets[i] if holders[x][0] < i}
        fewest = min((len(h) for h in shared.values()), default=0)
        partners = {h[0] for h in shared.values() if len(h) <= max(rare, 0)}
        ties = {h[0] for h in shared.values() if len(h) == fewest}
        out[i] = (own, partners, ties)
    return out


def test_equals_plain_version(spark, tmp_path):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    pool = [word() for _ in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.3 else word() for _ in range(rng.randint(1, 12)))) for i in range(80)]
    rows += [(100 + i, "same\n\ntext\nhere") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("lines", F.lit(1)).withColumn("gone", F.lit(2))
    found = {r.doc_id: r for r in without_lines(df.repartition(4), str(tmp_path), rare=10_000).collect()}
    for i, (own, partners, _) in brute_force(rows, 10_000).items():
        texts = dict(rows)
        gone = set()
        for p in partners:  # every partner: no line is too frequent here
            pairs = patience([0 if not x.strip() else hash(x) for x in own], [0 if not x.strip() else hash(x) for x in texts[p].split("\n")])
            runs, run = [], []
            for pair in pairs:
                if run and pair != (run[-1][0] + 1, run[-1][1] + 1):
                    runs.append(run)
                    run = []
                run.append(pair)
            for run in [*runs, run]:
                if any(own[x].strip() for x, _ in run):
                    gone |= {x for x, _ in run}
        kept = [x for n, x in enumerate(own) if n not in gone]
        assert (found[i]._n_lines, found[i]._n_removed) == (len(own), len(gone))
        assert found[i]._kept == ("\n".join(kept) if kept else None)


def test_first_holder_keeps_and_large_groups_find_it(spark, tmp_path):
    rows = [(i, f"own {i}\nshared one\nshared two") for i in range(300)] + [(999, "nothing\nlike it")]
    found = {r.doc_id: r._kept for r in without_lines(spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()}
    assert found[0] == rows[0][1] and found[999] == rows[-1][1]
    assert all(found[i] == f"own {i}" for i in range(1, 300))


def test_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "\n \n"), (None, "x\ny"), (4, "x\ny"), (4, "x\ny"), (4, "z\n" * 5000), (5, "z\n" * 5000)]
    found = Counter((r.doc_id, r._n_lines, r._n_removed) for r in without_lines(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a")).collect())
    assert found == Counter(
        [(1, 0, 0), (2, 1, 0), (3, 3, 0), (None, 2, 2), (4, 2, 0), (4, 2, 0), (4, 5001, 0), (5, 5001, 5001)]
    )
    assert without_lines(spark.createDataFrame([], SCHEMA), str(tmp_path / "b")).collect() == []


def test_frequent_lines_go_beside_rarer_ones(spark, tmp_path):
    """A line in more than 100 documents, in documents that share a rarer line with another one."""
    rows = [(i, f"own {i}\nfrequent one\nfrequent two") for i in range(150)] + [(200, "rare\nalone")]
    rows += [(300 + i, f"rare\nmore {i}\nfrequent one\nfrequent two") for i in range(5)]
    found = {r.doc_id: r._kept for r in without_lines(spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()}
    assert found[0] == rows[0][1] and found[200] == "rare\nalone"
    assert all(found[300 + i] == f"more {i}" for i in range(5))


def test_further_holders_are_all_pairs(spark, tmp_path):
    """As in the queries: a line stays only if it aligns with none of its earlier holders."""
    rng = random.Random(8)
    pool = [f"line {i}" for i in range(12)]
    rows = [(0, "l2\nx\nl1"), (1, "l1\nl2"), (2, "l1\nl2")]
    rows += [(10 + i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"{i} {k}" for k in range(rng.randint(1, 9)))) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {r.doc_id: r._kept for r in without_lines(df, str(tmp_path / "a"), further=True).collect()}
    first = {r.doc_id: r._kept for r in without_lines(df, str(tmp_path / "b")).collect()}
    assert found[2] is None and found != first
    for i, text in rows:
        own = text.split("\n")
        gone = set()
        for j, other in rows:
            if j < i and set(own) & set(other.split("\n")):
                gone |= {x for x, _ in _solid(patience(own, other.split("\n")), own)}
        kept = [x for n, x in enumerate(own) if n not in gone]
        assert found[i] == ("\n".join(kept) if kept else None)


def test_pairs_grow_with_lines_not_with_documents_squared(spark, tmp_path):
    """A line that stands twice in every document aligns with none; the documents are one class."""
    rows = [(i, f"a {i}\nShare\nb {i}\nShare\nc {i}") for i in range(600)]
    rows += [(1000 + i, f"Title\nx {i}\nTwice\ny {i}\nTwice") for i in range(200)] + [(5000, "Twice\nshort\nTwice\nTwice")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r._n_removed for r in without_lines(df, str(tmp_path), further=True).collect()}
    assert all(found[i] == 0 for i in range(600))
    assert found[1000] == 0 and all(found[1000 + i] == 3 for i in range(1, 200))
    pairs = sum(spark.read.parquet(str(p)).count() for p in tmp_path.glob("further/pairs-*"))
    assert pairs <= 10


def test_clashing_columns(spark, tmp_path):
    rows = [(1, "a\nb", 7, "x", 1, 2, 3), (2, "c\nb", 8, "y", 4, 5, 6)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, _gone int, _id string, _hash int, _kept int, place int")
    found = {r.doc_id: r.asDict() for r in without_lines(df, str(tmp_path), further=True).collect()}
    assert found[2] == {"doc_id": 2, "text": "c\nb", "_gone": 8, "_id": "y", "_hash": 4, "place": 6, "_n_lines": 2, "_n_removed": 1, "_kept": "c"}
