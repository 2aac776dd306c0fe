"""The queries on words: spelling variants, benchmark passages and periodic runs, over their whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, table
from tidemark.llm.periods import with_periods
from tidemark.llm.spelling import variants, word_counts
from tidemark.llm.winnowing import contamination

# crc32 by its table, which the rule below builds
_CRC = """
steps AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(list_concat([b], range(8)),
  lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM (SELECT unnest(range(256)) AS b)))"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text."""
    return f"""xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode({text}))),
  lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"""


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """All words of the documents, some misspelt by rule, with their variants."""
    place = scratch(spark)
    return variants(word_counts(table(spark, folder, "documents"), one_in=97), place)


OP11 = f"""
WITH RECURSIVE {_CRC},
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zA-Z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents),
c AS (SELECT d, w, count(*) AS k FROM r GROUP BY ALL),
h AS (SELECT w, k, {_crc32("d || ':' || w")} AS h FROM c, steps),
m AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) + 2 AS BIGINT)) ELSE w END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM m WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
x AS (SELECT word, n, i, substr(word, 1, CAST(i AS BIGINT)) || substr(word, CAST(i + 2 AS BIGINT)) AS less FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
near AS (SELECT a.word, b.word AS near, b.n FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, v.word, v.n FROM x JOIN v ON x.less = v.word
  UNION SELECT v.word, x.word, x.n FROM x JOIN v ON x.less = v.word),
best AS (SELECT word, count(*) AS n_near, min({{'n': -n, 'w': near}}) AS best FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 2 * v.n THEN best.w END AS form,
  CASE WHEN -best.n >= 2 * v.n THEN -best.n END AS form_n FROM v LEFT JOIN best ON best.word = v.word),
way AS (SELECT word, form AS here FROM f WHERE form IS NOT NULL UNION SELECT way.word, f.form FROM way JOIN f ON f.word = way.here WHERE f.form IS NOT NULL),
ends AS (SELECT way.word, here FROM way JOIN f ON f.word = way.here WHERE f.form IS NULL)
SELECT f.word, form, coalesce(ends.here, f.word) AS root, f.n, n_near, form_n FROM f LEFT JOIN ends ON ends.word = f.word
"""


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the words that lie in passages of the benchmark."""
    rows = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), scratch(spark))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
s AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM s)),
u AS (SELECT DISTINCT n FROM s),
e AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, u WHERE len(w) >= n)),
f AS (SELECT e.* FROM e SEMI JOIN g ON e.n = g.n AND e.g = g.g),
p AS (SELECT rid, count(DISTINCT i) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS i FROM f) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
  (SELECT DISTINCT rid, item FROM f JOIN g ON f.n = g.n AND f.g = g.g) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.rid = d.rid LEFT JOIN t ON t.rid = d.rid
"""


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The text, of one document in ten (by the checksum of its id) with its end replaced by repeats of a stretch."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    times = 3 + g % 8
    p = (1 + F.floor((n - a) / times)).cast("int")
    head, stretch = F.slice(words, F.lit(1), a), F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(stretch, (times + 1).cast("int"))), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(head, tail), " ")).otherwise(text)


def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, one in ten made periodic, with their periodic runs."""
    documents = table(spark, folder, "documents").select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    rows = with_periods(documents, "found").select("doc_id", "found")
    runs = F.arrays_zip(F.col("found.starts").alias("s"), F.col("found.lengths").alias("l"), F.col("found.periods").alias("p"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["l"].alias("l"), (-r["s"]).alias("s"), (-r["p"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["s"], r["l"], r["p"]))
    rows = rows.select("doc_id", "found.kept", runs.alias("runs")).withColumns({"best": best, "lines": F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")})
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.l) div (-best.p)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


OP13 = f"""
WITH {_CRC},
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
h AS (SELECT rid, doc_id, w, len(w) AS n, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM d, steps),
a AS (SELECT *, h // 10 AS g, (h // 10) % greatest(n, 1) AS a FROM h),
x AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
  w[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1 AS BIGINT)]) ELSE w END AS w FROM a),
u AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS w FROM x),
e AS (SELECT y.rid, y.i, z.i - y.i AS q FROM u y JOIN u z ON y.rid = z.rid AND y.w = z.w AND z.i > y.i AND 4 * (z.i - y.i) <= y.n),
k AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM e),
s AS (SELECT rid, q, min(i) AS s, count(*) + q AS l FROM k GROUP BY rid, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s t WHERE t.rid = s.rid AND t.q < s.q AND t.s <= s.s AND t.s + t.l >= s.s + s.l)),
o AS (SELECT DISTINCT rid, unnest(range(s + q, s + l)) AS i FROM r),
c AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS kept FROM u ANTI JOIN o ON o.rid = u.rid AND o.i = u.i GROUP BY rid),
t AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
  max({{'l': l, 's': -s, 'q': -q}}) AS b FROM r GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -b.s AS start, b.l AS length, -b.q AS period, 1000 * b.l // -b.q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM x LEFT JOIN t ON t.rid = x.rid LEFT JOIN c ON c.rid = x.rid
"""

QUERIES = {"op11_spelling": op11_spelling, "op12_decontamination": op12_decontamination, "op13_periodic": op13_periodic}
ORACLES = {"op11_spelling": OP11, "op12_decontamination": OP12, "op13_periodic": OP13}
