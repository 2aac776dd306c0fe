"""Toxicity and quality: held-out accuracy, and rows of every kind."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.quality import quality
from tidemark.llm.toxicity import Scorer, fitted, held_out, scored, train

LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice(["ta", "no", "re", "li", "mu"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(800):
        words = [word() for _ in range(rng.randint(5, 200))]
        if i % 3 == 0:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumpf", "blorgh"]) + rng.choice(["", "s", "ta", "xx"]))
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    return rows


def test_unseen_misspellings_share_their_grams():
    rows = corpus()
    model = train([t for i, t, _ in rows if i % 5], np.array([y for i, _, y in rows if i % 5]))
    scorer = Scorer(model)
    right = [(scorer.score(t) >= 0.5) == bool(y) for i, t, y in rows if i % 5 == 0]
    assert sum(right) / len(right) > 0.97
    assert min(scorer.score(f"tano relimu {w} muli re") for w in ("grumpfel", "blorghno", "GRUMPF")) > 0.5
    assert max(scorer.score(w) for w in ("", "tano relimu muli re", "zzz")) < 0.5


def test_score_is_that_of_the_worst_window():
    rows = corpus()
    model = train([t for _, t, _ in rows[:300]], np.array([y for _, _, y in rows[:300]]))
    scorer = Scorer(model)
    rng = random.Random(4)
    texts = [t for _, t, _ in rows[300:340]] + ["ta " * 500, "ta " * 70 + "no " * 70 + "ta"]
    texts.append(" ".join(rng.choice("abcdefghij") * 3 for _ in range(400)))
    for text in texts:
        words = text.lower().split()
        left = [w for i, w in enumerate(words) if w not in words[max(0, i - 64) : i]]
        worst = -np.inf
        for start in range(0, max(1, len(left) - 4), 4):
            window = left[start : start + 8]
            worst = max(worst, float(np.mean([model.words([w])[0] for w in window])))
        assert scorer.score(text) == pytest.approx(1 / (1 + np.exp(-(worst + model.bias))), abs=1e-6)


def test_a_passage_counts_wherever_its_words_stood_before():
    rows = corpus()
    scorer = Scorer(train([t for i, t, _ in rows if i % 5], np.array([y for i, _, y in rows if i % 5])))
    rng = random.Random(6)
    clean = [t for i, t, y in rows if not y and i % 5 == 0 and len(t.split()) > 100]
    passage = "grumpf blorghta grumpfs blorghxx grumpfta blorghs grumpfxx blorgh"
    for text in clean:
        words = text.split()
        for word in passage.split():
            words.insert(rng.randrange(len(words) + 1), word)
        far = " ".join(rng.choice(["tano", "relimu", "muli", "renota", "lili"]) for _ in range(70))
        assert scorer.score(" ".join([*words, far, passage])) > 0.5


def test_neither_label_falls_out_of_the_sample(spark):
    """Toxic texts that are all very long are learned from as well as short ones."""
    long = [(i, (t + " ") * (1 if not y else 1 + 30_000 // len(t)), "en", "s", 0) for i, t, y in corpus()]
    model = fitted(spark.createDataFrame(long, DOCS), spark.createDataFrame([(i, 1, y) for i, _, y in corpus()], LABELS))
    scorer = Scorer(model)
    right = [(scorer.score(t) >= 0.5) == bool(y) for i, t, y in corpus() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(right) / len(right) > 0.95


def test_scores_of_a_table(spark, tmp_path):
    rows = [(i, t, "en", "s", 0) for i, t, _ in corpus()]
    odd = [(9000, None, None, None, None), (9001, "", "en", "s", 0), (9002, "x" * 300_000, "en", "s", 1), (None, "ta", "en", "s", 1), (0, "again", "en", "s", 1)]
    docs = spark.createDataFrame(rows + odd, DOCS)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in corpus()] + [(3, 0, None), (4, None, 7), (None, 1, 1)], LABELS)
    found = scored(docs.withColumn("toxic", F.lit(1)), fitted(docs, labels)).select("doc_id", "score", held_out().alias("h")).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows + odd)
    assert all(0 <= r.score <= 1 for r in found)
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)
    held = [(r.score >= 0.5) == (r.doc_id % 3 == 0) for r in found if r.h and r.doc_id is not None and 0 < r.doc_id < 800]
    assert sum(held) / len(held) > 0.95


def test_held_out_labels_and_ids_change_nothing(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in corpus()], DOCS)
    whole = [(i, 1, y) for i, _, y in corpus()]
    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in whole]
    a, b = (fitted(docs, spark.createDataFrame(x, LABELS)) for x in (whole, turned))
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_no_labels_and_no_rows(spark, tmp_path):
    none, docs = spark.createDataFrame([], LABELS), spark.createDataFrame([(1, "a b", "en", "s", 1)], DOCS)
    assert [r.score for r in scored(docs, fitted(docs, none)).collect()] == [0.0]
    empty = spark.createDataFrame([], DOCS)
    assert scored(empty, fitted(empty, none)).collect() == []
    (row,) = quality(docs, none, str(tmp_path / "a")).collect()
    assert row.score == pytest.approx(0.5)
    assert quality(empty, none, str(tmp_path / "b")).collect() == []


def test_quality_shrinks_sparse_hosts(spark, tmp_path):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(2000):
        source = None if i % 40 == 0 else f"good{i % 3}" if i % 2 else f"bad{i % 3}"
        good = rng.random() < (0.95 if i % 2 else 0.3)
        text = " ".join(rng.choice(["fine", "words", "here"]) + ("" if good else "$$$") for _ in range(rng.randint(3, 60)))
        rows.append((i, text, "en", source, 0))
        labels.append((i, int(good), 0))
    rows += [(5000, "words here fine", "en", "rare", 0), (5001, None, None, "rare", 0), (0, "fine", "en", "good1", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)).withColumn("s", F.lit(1))
    found = quality(docs, spark.createDataFrame(labels[: len(labels) // 2], LABELS), str(tmp_path)).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    truth = {i: q for i, q, _ in labels}
    held = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in found if r.doc_id in truth and (r.held_out or r.doc_id >= 1000)]
    assert sum(held) / len(held) > 0.95
    host = {r.host: r.host_share for r in found}
    low, high = min(host.values()), max(host.values())
    assert low < host["rare"] < high and host["good1"] > 0.85 and host["bad0"] < 0.45
