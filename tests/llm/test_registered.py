"""The registered queries against DuckDB, and the pipeline stage by stage."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from compare import oracle, oracle_rows, spark_rows
from test_jaccard import brute_force

from tidemark.llm.entries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    assert rows
    if name in ORACLES:
        wanted, expected = oracle_rows(oracle(SF), ORACLES[name])
        assert names == wanted
        round_off = lambda x: Counter({tuple(round(v, 5) if isinstance(v, float) else v for v in r): n for r, n in x.items()})
        assert round_off(rows) == round_off(expected)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    results = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        results[name] = docs.collect()
        if name != "packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    kept = {r.doc_id: r for r in results["toxicity"]}
    assert all(kept[i] == whole[i] for i in kept) and len(kept) > 0.8 * len(whole)
    lines = {r.doc_id: r.text for r in results["line dedup"]}
    assert all(set(re.split("\n", t)) <= set(whole[i].text.split("\n")) for i, t in lines.items())
    everything = {x for r in results["toxicity"] for x in r.text.split("\n") if x.strip()}
    assert everything == {x for t in lines.values() for x in t.split("\n") if x.strip()}, "a line went missing"
    first = {i: c for i, (_, _, c) in brute_force(list(lines.items()), 5, 80).items()}
    one_each = {r.doc_id for r in results["n-gram Jaccard join"]}
    assert one_each == {i for i, c in first.items() if i == c}
    times = Counter(r.doc_id for r in results["mixing sources to target weights"])
    assert set(times) == one_each and max(times.values()) <= 2
    assert Counter(r.doc_id for r in results["packing"] if r.start == 0) == times


def test_stages_take_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (3, "\n\n", "en", None, 2)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"
    for given in ([(*r, 7) for r in rows], []):
        docs = spark.createDataFrame(given, schema)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{len(given)}-{number}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert {r.doc_id for r in docs.collect()} == ({1, 2, 3, None} if given else set())


def test_unlike_texts_under_one_id_stay(spark):
    words = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(2, words("a")), (2, words("b")), (2, words("b")), (3, words("a")), (1, words("b") + " more"), (4, words("c")), (None, words("c")), (5, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, SF).collect()]
    assert Counter(t for _, t in got if t) == {words("a"): 1, words("b") + " more": 1, words("c"): 2}
    assert {i for i, t in got if t == words("a")} <= {2, 3} and {i for i, t in got if not t} == {5}
