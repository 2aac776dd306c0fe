"""Spelling variants, benchmark passages and periodic runs against brute force."""

import random
import re
import zlib

from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.periods import runs_of, with_periods
from tidemark.llm.spelling import frequent_grams, gram_pattern, near_words, variants, word_counts
from tidemark.llm.winnowing import contamination


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def vocabulary():
    rng = random.Random(3)
    words = {"aaaaa", "aaaaaa", "aaaaaaa", "baaaa", "aaaab", "éaaaa", "x" * 400, "x" * 399, "x" * 150 + "y" + "x" * 249, "y" * 4000}
    for _ in range(60):
        word = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        words.add(word)
        for _ in range(8):
            at, kind, letter = rng.randrange(len(word) + 1), rng.randrange(3), rng.choice("abcé")
            words.add(word[:at] + letter * (kind > 0) + word[at + (kind < 2) :])
    return sorted(words)


def test_near_words_are_all_found(spark, tmp_path):
    words = vocabulary()
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    expected = {(a, b) for a in words for b in words if a != b and one_edit(a, b)}
    for share, most in ((0.02, 3), (0.2, 2), (0.0, 5), (1.0, 3)):
        got = [tuple(r) for r in near_words(df, str(tmp_path / f"{share}"), share, most).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_grams(spark):
    df = spark.createDataFrame([("banana",), ("bandana",), ("cabana",)], "word string")
    frequent = frequent_grams(df, 0.1, 3)
    assert set(frequent) == {"^", "$", "a", "n", "b", "an", "na", "a$", "ba"}  # at least 3 of 25 places
    assert gram_pattern(["a", "an"]).findall("^banana$") == ["^", "b", "ana", "n", "a$"]


def test_variants(spark, tmp_path):
    rows = [("house", 100), ("hous", 0), ("houses", 40), ("mouse", 49), ("housee", 100), ("hxuse", 100), ("lone", 9), ("horse", 50), ("morse", 3)]
    got = {r.word: tuple(r)[1:] for r in variants(spark.createDataFrame(rows, "word string, n bigint"), str(tmp_path)).collect()}
    assert got["houses"] == ("house", "house", 40, 2, 100)  # house and housee tie, the first stands
    assert got["house"] == (None, "house", 100, 6, None)
    assert got["horse"] == ("house", "house", 50, 2, 100) and got["morse"] == ("horse", "house", 3, 2, 50)
    assert got["lone"] == (None, "lone", 9, 0, None)


def test_no_list_and_no_vocabulary_is_broadcast(spark, tmp_path, monkeypatch):
    """However small Spark takes a side for: lists are many times larger than the words they are made from."""
    plans, stored = [], spelling.stored
    plan = lambda frame: plans.append(frame._jdf.queryExecution().executedPlan().toString()) or frame
    monkeypatch.setattr(spelling, "stored", lambda frame, path: stored(plan(frame), path))
    rows = [("house", 100), ("houses", 40), ("houuses", 3), ("lone", 9)]
    got = plan(variants(spark.createDataFrame(rows, "word string, n bigint"), str(tmp_path))).collect()
    assert {(r.word, r.form, r.root) for r in got} == {("house", None, "house"), ("houses", "house", "house"), ("houuses", "houses", "house"), ("lone", None, "lone")}
    assert sum(p.count("SortMergeJoin") for p in plans) >= 7 and not any("Broadcast" in p for p in plans)


def test_word_counts(spark):
    rows = [(1, "Éclair éclair ECLAIR'S xyzzy"), (None, "éclairĀéclair"), (1, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit(1)).withColumn("word", F.lit("w"))
    assert {tuple(r) for r in word_counts(df, 5, 1).collect()} == {("Éclair", 1), ("éclair", 3), ("eclair", 1), ("xyzzy", 1)}
    many = spark.createDataFrame([(i, "spelling mistake") for i in range(400)], "doc_id bigint, text string")
    expected = {}
    for i in range(400):
        for word in ("spelling", "mistake"):
            h = zlib.crc32(f"{i}:{word}".encode())
            word = word if h % 7 else word[: h % len(word)] + word[h % len(word) + 1 :]
            expected[word] = expected.get(word, 0) + 1
    assert {r.word: r.n for r in word_counts(many, 5, 1, 7).collect()} == expected


def test_no_words(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert variants(word_counts(none), str(tmp_path)).collect() == []


def words_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def hits(text, items, span):
    words, hit, found = words_of(text), set(), set()
    for item, other in items:
        own = words_of(other)
        size = min(span, len(own))
        for j in range(len(own) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[j : j + size]:
                    hit |= set(range(i, i + size))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def test_contamination_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    word = lambda n=9: rng.choice(["a", "b", "C", "ü", "x1", "Zed", "日本", "q", "9"][:n])
    text = lambda n, k=9: rng.choice([" ", ", ", "-"]).join(word(k) for _ in range(n))
    items = [(1, text(30)), (10, text(14)), (2, text(14)), (3, "solo"), (4, "two words"), (5, None), (6, ""), (None, text(12)), (7, " ?! ")]
    items += [(20 + i, "common passage of exactly ten words in each item here " + text(i)) for i in range(5)] + [(2, text(11))]
    docs = [None, "", "...", "SOLO", "a solo, two; words", "two word", items[0][1].upper(), text(300, 2)]
    for _ in range(60):
        item = rng.choice(items)[1] or ""
        cut = item.split(" ")
        a, n = rng.randrange(len(cut) + 1), rng.randint(5, 30)
        docs.append(text(rng.randint(0, 12)) + " " + " ".join(cut[a : a + n]) + " " + text(rng.randint(0, 12)))
    docs += ["x " * 40 + "common passage of exactly ten words in each item here" + " y" * 40] * 3
    rows = [(i // 2, t, "en") for i, t in enumerate(docs)] + [(None, "solo", "en"), (None, "other", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string").repartition(4)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, span int")
    for span in (10, 3):
        got = contamination(df, bench, str(tmp_path / f"{span}"), span).collect()
        expected = [(i, *hits(t, items, span)) for i, t, _ in rows]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_contamination_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(none, items, str(tmp_path / "a")).collect() == []
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert [tuple(r) for r in contamination(docs, items, str(tmp_path / "b")).collect()] == [(1, 2, 0, [])]


def runs_by_hand(words, times=4, least=6):
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            own = words[i : i + size]
            if j > i and size >= max(least, times * q) and all(own[d:] != own[: size - d] for d in range(1, q)):
                out.append([i, size, q])
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts():
    rng = random.Random(8)
    texts = [[], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"a", b"b"] * 500 + [b"a"], [b"%d" % (i % 37) for i in range(37 * 4 - 1)]]
    for _ in range(400):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [b"%d" % rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randint(0, 12))]
            stretch = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(1, 9))]
            words += (stretch * rng.randint(1, 7))[: rng.randint(0, 50)]
        texts.append(words)
    return texts


def test_runs_equal_brute_force():
    texts = periodic_texts()
    for times, least in ((4, 6), (3, 4), (5, 12)):
        for words, runs in zip(texts, runs_of(texts, times, least), strict=True):
            assert runs.tolist() == runs_by_hand(words, times, least)
    assert runs_of([]) == [] and [len(x) for x in runs_of([[], []])] == [0, 0]


def test_collapsed_text(spark):
    rows = [(1, "x\ta b\n a b a b a b  y"), (2, None), (2, ""), (None, "z z z z z z z z"), (4, "é " * 9), (4, "é " * 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("periodic", F.lit(1)).withColumn("kept", F.lit("k"))
    got = [(r.doc_id, r.kept, r.periodic.starts, r.periodic.lengths, r.periodic.periods, r.periodic.kept) for r in with_periods(df).collect()]
    assert got == [
        (1, "k", [1], [8], [2], "x a b y"),
        (2, "k", [], [], [], ""),
        (2, "k", [], [], [], ""),
        (None, "k", [0], [6], [1], "z z z"),
        (4, "k", [0], [9], [1], "é"),
        (4, "k", [0], [9], [1], "é"),
    ]
    assert with_periods(df.limit(0)).collect() == []
