"""Spelling variants: words one edit apart, found through an index of variable-length grams.

Two words are near if exactly one inserted, deleted or replaced code point turns one into the
other. A word's form is its most frequent near word, if that is frequent enough; its root is where
forms lead.

1. *Gram dictionary.* Words get a mark at each end. A gram that more than ``share`` of all places in
   words hold is frequent; all others are pruned. Counts cover all words, but of each length fewer
   than ``1 / share`` grams can be frequent, so the dictionary has a fixed bound.
2. *Decomposition.* From its start a word is cut into grams that do not overlap. Each is the shortest one
   that is not frequent, of ``most`` characters at most: rare characters stand alone, common ones
   draw in the next. Where a gram ends depends on its own characters only.
3. *Affected grams.* So an edit affects one gram of a word (an insertion between two: the second), and all
   others are in the near word too, those before it as grams of it, those after it as its end. That
   is the bound on what must be shared: all grams but one. A list is therefore kept for each word and
   gram left out, by a hash of what comes before and after, and not for each gram, whose lists would grow with
   the vocabulary.
4. *Merging.* A word asks for one list for each of its grams. It stands in those with any 0 to
   ``most`` characters left out from where one of its grams starts, as many as the other word's gram
   may have left. Longer words ask for shorter ones, equally long ones for each other.
5. *Verification.* What the lists hold is compared by edit distance: the parts left out, then the words.

Words are rows all along; no list and no vocabulary is gathered in one place. Joins are hinted: Spark takes what comes
out of lists for as small as the words that went in, which are many times fewer, and would broadcast it.

Documents that share an id are counted each, as are rows that repeat; a null id counts as an empty
text. Null and empty texts have no words. Other columns are ignored. No rows: no result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, stored
from tidemark.llm.shingles import grown, mix

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
START, END = "^", "$"
_HELD = 200_000
_CHARACTERS = 500_000
_FACTOR = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def misspelt(run: str, start: int, one_in: int) -> str:
    """The run without one of its letters, if its checksum says so; start is the checksum of what comes first."""
    h = zlib.crc32(run.encode(), start)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(documents: DataFrame, shortest: int = 5, fewest: int = 3, one_in: int | None = None) -> DataFrame:
    """word, n: the words of at least so many letters that occur so often, A-Z as a-z.

    ``one_in`` drops a letter of about one in so many (document, word), as the checksum of
    ``<doc_id>:<word>`` says: known misspellings for tests.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                runs = RUNS.findall((text or "").encode("utf-8", "replace").lower().decode())  # bytes: A-Z alone
                if one_in is None:
                    total.update(run for run in runs if len(run) >= shortest)
                else:
                    start = zlib.crc32(f"{doc}:".encode())
                    for run, n in Counter(runs).items():
                        word = misspelt(run, start, one_in)
                        if len(word) >= shortest:
                            total[word] += n
                if len(total) > _HELD:
                    yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                    total.clear()
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = rows.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= fewest)


def frequent_grams(words: DataFrame, share: float, most: int) -> list[str]:
    """Grams of fewer than ``most`` characters that more than a share of all places in marked words hold.

    Of each length there are fewer than ``1 / share``, however many words there are.
    """
    marked = words.select(F.concat(F.lit(START), "word", F.lit(END)).alias("z"))
    places = marked.agg(F.sum(F.length("z"))).first()[0] or 0
    out: list[str] = []
    for size in range(1, most):
        at = F.explode(F.sequence(F.lit(1), F.length("z") - (size - 1)))
        grams = marked.where(F.length("z") >= size).select("z", at.alias("at")).select(F.substring("z", F.col("at"), F.lit(size)).alias("gram"))
        counts = grams.groupBy("gram").agg(F.count("*").alias("n"))
        out += [r["gram"] for r in counts.where(F.col("n") > share * places).collect()]
    return sorted(out)


def gram_pattern(frequent: list[str]) -> re.Pattern:
    """Matches the gram at a place: a frequent gram goes on by a character, and at most so far as one is known."""
    longest_first = sorted(frequent, key=lambda x: (-len(x), x))
    return re.compile("".join(f"{re.escape(x)}.?|" for x in longest_first) + ".", re.DOTALL)


def _keys(words: list[str], pattern: re.Pattern, most: int, asking: bool) -> tuple[np.ndarray, list[str], np.ndarray]:
    """For each list that words ask for, or stand in: a hash of what stays, what is left out, the word's number."""
    global _powers, _inverse
    marked = [f"{START}{w}{END}" for w in words]
    grams = [[len(x) for x in pattern.findall(z)] for z in marked]
    whole = "".join(marked)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    _powers = grown(_powers, _FACTOR, len(codes) + 1)
    _inverse = grown(_inverse, pow(_FACTOR, -1, 1 << 64), len(codes) + 1)
    before, after = np.zeros(len(codes) + 1, np.uint64), np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes) * _powers[: len(codes)], out=before[1:])
    np.cumsum(mix(codes) * _inverse[: len(codes)], out=after[1:])
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), [len(x) for x in grams])
    long = np.fromiter((n for x in grams for n in x), np.int64, len(owner))
    place = np.cumsum(long) - long  # of the gram, among all characters
    steps = [long] if asking else [np.full(len(owner), x) for x in range(most + 1)]
    keys, left, owners = [], [], []
    for step in steps:
        rest = place + step
        fits = rest <= end[owner]
        own, p, q = owner[fits], place[fits], rest[fits]
        s, e = end[own] - size[own], end[own]
        head = mix((before[p] - before[s]) * _inverse[s] + (p - s).astype(np.uint64))
        tail = (after[e] - after[q]) * _powers[e] + (e - q).astype(np.uint64)
        keys.append(mix(head * np.uint64(3) + tail).view(np.int64))
        left += [whole[x:y] for x, y in zip(p.tolist(), q.tolist(), strict=True)]
        owners.append(own)
    return np.concatenate(keys), left, np.concatenate(owners)


def lists(words: DataFrame, frequent: list[str], most: int, asking: bool) -> DataFrame:
    """key, id, part: the lists that words (word, id) ask for, or stand in, and the part of the word they leave out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = gram_pattern(frequent)
        for batch in batches:
            column, ids, start = batch.column("word"), batch.column("id"), 0
            sizes = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False))
            while start < len(column):  # so many at a time that the arrays stay small
                end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + _CHARACTERS)))
                keys, left, owner = _keys(column.slice(start, end - start).to_pylist(), pattern, most, asking)
                columns = [pa.array(keys), ids.slice(start, end - start).take(pa.array(owner)), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "id", "part"])
                start = end

    return words.select("word", "id").mapInArrow(run, "key bigint, id bigint, part string")


def _moved(frame: DataFrame) -> DataFrame:
    """One side of a join that is to be shuffled and sorted, however small Spark takes it for."""
    return frame.hint("merge")


def near_words(words: DataFrame, folder: str, share: float = 0.02, most: int = 3) -> DataFrame:
    """word, near: all pairs of different words (each way round) that are one edit apart.

    What stays is the same in both words of a list, so they are one edit apart if the parts left out
    are. Words stand for themselves by a hash meanwhile; the pairs found are compared as whole words once more.
    """
    named = words.select("word", F.xxhash64("word").alias("id"))
    frequent = frequent_grams(words, share, most)
    asked = lists(named, frequent, most, True)
    held = lists(named, frequent, most, False).select("key", F.col("id").alias("other"), F.col("part").alias("its"))
    met = asked.join(_moved(held), "key").where(F.length("part") >= F.length("its")).where(F.levenshtein("part", "its", 1) == 1)
    found = stored(met.select("id", "other").distinct(), f"{folder}/found")
    pairs = found.join(_moved(named), "id").join(_moved(named.select(F.col("id").alias("other"), F.col("word").alias("near"))), "other")
    pairs = stored(pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "near"), f"{folder}/pairs")
    dropped(words.sparkSession, f"{folder}/found")
    other_way = pairs.where(F.length("word") > F.length("near")).select(F.col("near").alias("word"), F.col("word").alias("near"))
    return pairs.unionByName(other_way)


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root: where the forms (word, form) of words lead; each turn doubles the steps taken.

    Forms are much more frequent than their words, so ways are short and end.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), f"{folder}/0")
    turn = 0
    while True:
        next_ = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        turn += 1
        after = now.join(_moved(next_), "root", "left")
        after = stored(after.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), f"{folder}/{turn}")
        dropped(forms.sparkSession, f"{folder}/{turn - 1}")
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def variants(words: DataFrame, folder: str, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for words (word, n), each once.

    The form is the near word with the largest n, of equal ones the first in code-point order, if
    its n is at least ``times`` that of the word; otherwise null, as is form_n.
    """
    words = stored(words, f"{folder}/words")
    near = near_words(words, f"{folder}/near")
    with_n = near.join(_moved(words.select(F.col("word").alias("near"), "n")), "near")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("near").alias("form"))).alias("best")
    best = with_n.groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(_moved(best), "word", "left")
    enough = -F.col("best.n") >= times * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    known = stored(known, f"{folder}/forms")
    ends = roots(known.where("form is not null").select("word", "form"), f"{folder}/roots")
    return known.join(_moved(ends), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
