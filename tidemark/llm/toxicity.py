"""Toxicity: subword-bag embeddings, averaged, into a linear softmax.

A word is a bag of its character n-grams, with marks at both ends, and of itself; each of them that
occurs often enough in training has a vector in a hashed table, the others are zero. A window of words is the
average of its words' vectors; words that came among the 64 before do not count again, those that
stood further back do, so a toxic passage counts wherever it stands. A linear softmax on top
tells toxic from clean, and both are trained jointly in numpy. A misspelling that was never seen
shares most of its n-grams with known words, so it gets nearly their vector.

A few words make a long document toxic, so a document's score is that of its worst window, and
training knows it: every window of a clean document is clean, and of a toxic one, after a first
phase that takes all of its windows, the one that scores highest is toxic.

Training uses a bounded sample of the labelled documents, up to ``sample`` of each label in order of
a hash of the id; a text of more than ``longest`` characters counts by as many, in stretches that are
spread over it. Documents whose crc32 of the id leaves 0 when divided by 5 are held
out (a null id counts as an empty text, which is). Only text enters the model. The model, of fixed size, goes to the tasks as one number for each
n-gram: the softmax of two classes needs only the difference of its inputs.

Null and empty texts, and texts of unknown n-grams only, score 0.27, as the fixed bias says. Rows that repeat an id are scored
each. Labels that are null, or neither 0 nor 1, are not used; an id with several labels counts with
the largest. Without labels of both kinds, every score is 0. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held

WINDOW = 8
APART = 64
BITS = 22
GRAMS = (3, 4, 5)
LEAST = 5
_KNOWN = 200_000
_AT_ONCE = 10_000


_STRETCH = 2000


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def gram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of words, each with its word's place in the list."""
    text = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    places, grams = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in GRAMS:
            whole = np.flatnonzero(word[: len(rolled)] == word[n - 1 :])
            places.append(whole)
            grams.append((rolled[whole] * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - BITS))
    # the word itself, so that none is without grams
    total = np.add.reduceat(codes * (np.arange(len(codes), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64) + np.uint64(7)), starts)
    places.append(starts)
    grams.append((total * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS))
    return np.concatenate(grams).astype(np.int64), word[np.concatenate(places)]


@dataclass
class Model:
    """What scoring needs: by how much each n-gram speaks for toxic, and the bias."""

    weights: np.ndarray
    bias: float

    def words(self, words: list[str]) -> np.ndarray:
        grams, word = gram_ids(words)
        return np.bincount(word, self.weights[grams], len(words)) / np.bincount(word, minlength=len(words))


def fresh(words: list[str]) -> list[str]:
    """The words without those that came among the ``APART`` before them."""
    last: dict[str, int] = {}
    out = []
    for at, word in enumerate(words):
        if at - last.get(word, -APART - 1) > APART:
            out.append(word)
        last[word] = at
    return out


def windows_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows of n words: each overlaps half of the next."""
    starts = np.arange(0, max(1, n - WINDOW // 2), WINDOW // 2)
    return starts, np.minimum(starts + WINDOW, n)


def train(texts: list[str], toxic: np.ndarray, width: int = 8, turns: tuple[int, int] = (10, 30), decay: float = 1e-5, seed: int = 5) -> Model:
    """Embeddings and softmax, trained together by full passes of Adam."""
    number: dict[str, int] = {}
    flat, first, last, owner = [], [], [], []
    for doc, text in enumerate(texts):
        own = [number.setdefault(w, len(number)) for w in fresh(text.lower().split())]
        a, b = windows_of(len(own))
        first += (a + len(flat)).tolist()
        last += (b + len(flat)).tolist()
        owner += [doc] * len(a)
        flat += own
    if not flat:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    words, first, last, owner = np.array(flat), np.array(first), np.array(last), np.array(owner)
    some = last > first
    first, last, owner = first[some], last[some], owner[some]
    names = list(number)
    parts = [(at, *gram_ids(names[at : at + _AT_ONCE])) for at in range(0, len(names), _AT_ONCE)]
    grams = np.concatenate([g.astype(np.int32) for _, g, _ in parts])
    gram_word = np.concatenate([(w + at).astype(np.int32) for at, _, w in parts])
    del parts
    order = np.argsort(gram_word, kind="stable")
    grams, gram_word = grams[order], gram_word[order]
    n_grams = np.bincount(gram_word, minlength=len(number))
    often = np.bincount(grams, np.bincount(words, minlength=len(number))[gram_word], 1 << BITS) >= LEAST
    kept = often[grams]
    grams, gram_word = grams[kept], gram_word[kept]
    used, grams = np.unique(grams, return_inverse=True)
    if not len(used):
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    begin = np.searchsorted(gram_word, np.arange(len(number)))
    has = np.append(begin[1:], len(grams)) > begin
    label = toxic[owner].astype(np.float32)
    bag = np.sort(np.unique(owner, return_index=True)[1])
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.1, (len(used), width)).astype(np.float32)
    softmax = random.normal(0, 0.5, (width, 2)).astype(np.float32)
    bias = np.array([0.5, -0.5], np.float32)  # fixed: text without known n-grams is clean
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (table, softmax)]
    size = (last - first).astype(np.float32)[:, None]
    for turn in range(1, sum(turns) + 1):
        vectors = np.zeros((len(number), width), np.float32)
        vectors[has] = np.add.reduceat(table[grams], begin[has]) / n_grams[has, None]
        running = np.zeros((len(words) + 1, width))
        np.cumsum(vectors[words], axis=0, out=running[1:])
        mean = ((running[last] - running[first]) / size).astype(np.float32)
        score = mean @ softmax + bias
        chance = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -30, 30)))
        weight = np.ones(len(label), np.float32)
        if turn > turns[0]:  # a document is what its worst window is
            best = np.maximum.reduceat(chance, bag)
            milder = chance < np.repeat(best, np.diff(np.append(bag, len(owner))))
            weight[milder] = np.where(label[milder] == 1, 0, 0.05)
        weight[label == 1] *= weight[label == 0].sum() / max(1.0, weight[label == 1].sum())
        slope = weight * (chance - label) / weight.sum()
        both = np.stack([-slope, slope], axis=1)
        back = both @ softmax.T / size
        edge = np.zeros((len(words) + 1, width))
        for i in range(width):
            edge[:, i] = np.bincount(first, back[:, i], len(words) + 1) - np.bincount(last, back[:, i], len(words) + 1)
        per_word = np.cumsum(edge, axis=0)[:-1]
        down = np.empty_like(table)
        for i in range(width):
            one = np.bincount(words, per_word[:, i], len(number)) / n_grams
            down[:, i] = np.bincount(grams, one[gram_word], len(used))
        moves = (down, mean.T @ both)
        for x, g, (m, v) in zip((table, softmax), moves, state, strict=True):
            g = g + decay * x
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-12)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = table @ (softmax[:, 1] - softmax[:, 0])
    return Model(weights, float(bias[1] - bias[0]))


def training_rows(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Text and label of the sample."""
    known = (
        labels.where("toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out())
        .withColumn("order", F.xxhash64("doc_id"))
    )
    chosen = known.where("toxic = 0").orderBy("order", "doc_id").limit(sample)
    chosen = chosen.unionByName(known.where("toxic = 1").orderBy("order", "doc_id").limit(sample))
    # at most 2 * sample rows: small enough to send to every task
    found = documents.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")
    return found.where("text is not null").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def fitted(documents: DataFrame, labels: DataFrame, sample: int = 600, longest: int = 4000) -> Model:
    """A model from a bounded sample: texts in order of a hash of the id, as many of either label.

    A longer text than ``longest`` characters counts by stretches of it, evenly spread, so neither
    label and no length of texts can fall out of the sample.
    """
    size, parts = F.length("text"), max(1, longest // _STRETCH)
    starts = F.array(*[F.floor(i * (size - _STRETCH) / max(1, parts - 1)).cast("int") + 1 for i in range(parts)])
    spread = F.array_join(F.transform(starts, lambda at: F.substring("text", at, F.lit(_STRETCH))), " ")
    rows = training_rows(documents, labels, sample).withColumn("text", F.when(size > max(longest, _STRETCH), spread).otherwise(F.col("text")))
    data = rows.orderBy("doc_id").select("text", "toxic").collect()
    toxic = np.array([r["toxic"] for r in data], np.int64)
    if len(set(toxic.tolist())) < 2:
        return Model(np.zeros(1 << BITS, np.float32), -np.inf)
    return train([r["text"] for r in data], toxic)


class Scorer:
    """Scores texts; keeps what it knows of words, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def score(self, text: str) -> float:
        words = fresh(text.lower().split())
        if not words:
            return _chance(self.model.bias)
        known = self.known
        try:
            values = [known[w] for w in words]
        except KeyError:
            new = [w for w in dict.fromkeys(words) if w not in known]
            if len(known) + len(new) > _KNOWN:
                known.clear()
                new = list(dict.fromkeys(words))
            for at in range(0, len(new), _AT_ONCE):
                some = new[at : at + _AT_ONCE]
                known.update(zip(some, self.model.words(some).tolist(), strict=True))
            values = [known[w] for w in words]
        total = np.concatenate([[0.0], np.cumsum(values)])
        a, b = windows_of(len(words))
        return _chance(float(((total[b] - total[a]) / (b - a)).max()) + self.model.bias)


def _chance(x: float) -> float:
    return 0.0 if x < -700 else 1 / (1 + math.exp(-x))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """The documents' columns and score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = "scorer", float(shared.value.weights.sum()), shared.value.bias
        scorer = held(key, lambda: Scorer(shared.value))
        for batch in texts:
            yield pd.Series([scorer.score(t or "") for t in batch], dtype="float64")

    return documents.withColumn("score", F.pandas_udf(run, "double")("text"))
