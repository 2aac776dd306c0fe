"""Packing: ids as the tokenizer gives them, each in one piece, pieces side by side."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.packing import Encoder, packed, plan

FILES = [str(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")]
WHOLE = Tokenizer.from_file(FILES[0])
OWN = Encoder(*FILES, public_tokenizers.PATTERN)
SCHEMA = "doc_id bigint, text string"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sSre.1é|<>日  "), st.characters(codec="utf-8")), max_size=40))
def test_ids_are_the_tokenizers(text):
    assert OWN.ids(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_ids_of_whole_tables(spark):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["a<|endoftext|>b", " lead", "trail ", "two  spaces", "x \n y", "don't we'll", "日本 語", "w" * 5000]
    for text in texts:
        assert OWN.ids(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_plan_uses_the_histogram_up(counts):
    histogram = np.zeros(65, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    used = Counter()
    for group, times in plan(histogram, 64):
        assert sum(group) <= 64 and times > 0
        for x in group:
            used[x] += times
    assert dict(used) == {x: n for x, n in counts.items() if n}


def check(rows, found, window):
    ids = {i: np.array([*WHOLE.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    seen, sequences = Counter(), {}
    for r in found:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start : r.start + r.length]) == r.ids_crc32
        seen[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    copies = Counter(i for i, _ in rows)
    assert seen == {i: copies[i] * len(x) for i, x in ids.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    return 1 - sum(seen.values()) / (window * len(sequences))


@pytest.mark.parametrize("window", [64, 2048])
def test_packed(spark, tmp_path, window):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randint(0, 900)))) for i in range(300)]
    rows += [(1000 + i, "a third of all are equal " * 20) for i in range(150)] + [(2000, None), (2001, ""), (2002, "x y " * 20_000)]
    df = spark.createDataFrame(rows + rows[:3], f"{SCHEMA}").repartition(5).selectExpr("*", "1 AS rank", "2 AS length")
    padding = check(rows + rows[:3], packed(df, str(tmp_path), *FILES, public_tokenizers.PATTERN, window).collect(), window)
    assert padding < 0.05


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert packed(none, str(tmp_path), *FILES, public_tokenizers.PATTERN).collect() == []
