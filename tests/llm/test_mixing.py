"""Mixtures: limits, targets, budgets, and edge cases."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import byte_tokens, mixed

SIZES = {"a": 300, "b": 60, "c": 20, None: 4}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(n * 1000 + i, s, 5 + i % 7) for n, (s, size) in enumerate(SIZES.items()) for i in range(size)]
    return spark.createDataFrame(data, "doc_id bigint, source string, tokens bigint").withColumn("p", F.lit(1)).withColumn("left", F.lit(2))


def shares(found):
    total = Counter()
    for r in found:
        total[r.source] += r.mix_tokens
    return total


def test_repeats_reach_the_limit_and_not_more(rows, tmp_path):
    total = Counter()
    for r in rows.collect():
        total[r.source] += r.tokens
    found = mixed(rows, str(tmp_path), F.col("tokens"), "all", max_repeats=2.0, block_tokens=100).collect()
    used = shares(found)
    assert all(used[s] <= 2.0 * total[s] for s in total) and used[None] > 1.5 * total[None]
    assert 0.95 * sum(total.values()) < sum(used.values()) <= sum(total.values())
    for (source, epoch), ids in group(found).items():
        assert len(ids) == len(set(ids)), "a row twice in an epoch"
        whole = epoch < max(e for s, e in group(found) if s == source)
        assert not whole or len(ids) == SIZES[source]


def group(found):
    out = defaultdict(list)
    for r in found:
        out[r.source, r.mix_epoch].append(r.doc_id)
    return out


def test_nothing_is_dropped_without_a_budget(rows, tmp_path):
    found = mixed(rows, str(tmp_path), F.col("tokens"), max_repeats=1.5, block_tokens=50).collect()
    times = Counter(r.doc_id for r in found)
    assert set(times) == {r.doc_id for r in rows.collect()} and max(times.values()) == 2


def test_entropy_target(rows, tmp_path):
    found = mixed(rows, str(tmp_path), F.col("tokens"), "all", min_entropy=0.9).collect()
    used = shares(found)
    p = [x / sum(used.values()) for x in used.values()]
    assert abs(-sum(x * math.log(x) for x in p) / math.log(len(p)) - 0.9) < 0.02


def test_blocks_are_permuted_anew_in_each_epoch(rows, tmp_path):
    found = mixed(rows, str(tmp_path), F.col("tokens"), 20_000, max_repeats=9.0, block_tokens=60).collect()
    orders = defaultdict(set)
    for r in found:
        orders[r.source, r.mix_epoch].add((r.mix_block_order, r.mix_block))
    runs = [tuple(sorted(x)) for (s, _), x in orders.items() if s == "b"]
    assert len(runs) > 3 and len(set(runs)) == len(runs)


def test_edges(spark, tmp_path):
    schema = "doc_id bigint, text string, source string"
    none = spark.createDataFrame([], schema)
    assert mixed(none, str(tmp_path / "a"), byte_tokens(), max_repeats=2.0).collect() == []
    data = [(1, None, "x"), (1, None, "x"), (None, "", "x"), (2, "y" * 100_000, None), (3, "", "")]
    found = mixed(spark.createDataFrame(data, schema), str(tmp_path / "b"), byte_tokens(), max_repeats=1.0).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(data)
    with pytest.raises(ValueError):
        mixed(none, str(tmp_path), byte_tokens())
