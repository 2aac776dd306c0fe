"""One query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, table
from tidemark.llm.jaccard import jaccard_join
from tidemark.llm.linededup import without_lines
from tidemark.llm.mixing import byte_tokens, mixed
from tidemark.llm.neardup_vectors import near_vectors
from tidemark.llm.packing import packed
from tidemark.llm.quality import quality
from tidemark.llm.repeats import without_repeats
from tidemark.llm.toxicity import fitted, held_out, scored
from tidemark.llm.topk import sound_vectors, top_k
from tidemark.llm.warc import read_warc, write_warc


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records, written and read back."""
    place = scratch(spark)
    write_warc(table(spark, folder, "pages"), place)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return read_warc(spark, place, payloads=False).select(*columns)


OP1 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS s FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS f FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(s, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to
FROM g
"""


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their scores; hosts are sources, and languages stand for paths within them."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    rows = quality(documents, table(spark, folder, "labels"), scratch(spark))
    numbers = {"evidence": "evidence", "host_share": "host", "path_share": "path", "score": "score"}
    rounded = [F.round(column, 6).alias(name) for column, name in numbers.items()]
    return rows.select("doc_id", "held_out", *rounded, (F.col("score") >= 0.5).alias("kept"))


OP2 = """
WITH d AS (SELECT doc_id, source AS h, lang AS p, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 5 = 0 AS held_out FROM documents),
f AS (SELECT *, [{'f': 'symbols', 'b': least(7, floor(32.0::DOUBLE * (n - length(translate(t, '#$%&*|!', ''))) / (n + 1)))::INT},
  {'f': 'capitals', 'b': least(7, floor(8.0::DOUBLE * (n - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) / (n + 1)))::INT},
  {'f': 'size', 'b': length(bin(n))::INT},
  {'f': 'word', 'b': least(15, floor(n / (1.0::DOUBLE + n - length(replace(t, ' ', '')))))::INT},
  {'f': 'line', 'b': length(bin(floor(n / (1.0::DOUBLE + n - length(replace(t, chr(10), ''))))::BIGINT))::INT},
  {'f': 'varied', 'b': floor(8.0::DOUBLE * len(list_distinct(string_split(t, ' '))) / len(string_split(t, ' ')))::INT}] AS x FROM d),
l AS (SELECT doc_id, min(quality) AS y FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
g AS (SELECT f.*, CASE WHEN NOT held_out THEN y END AS y FROM f LEFT JOIN l USING (doc_id)),
s AS (SELECT b.f AS f, b.b AS b, sum(y) AS good, count(*) AS n FROM (SELECT y, unnest(x) AS b FROM g WHERE y IS NOT NULL) GROUP BY ALL),
o AS (SELECT f, sum(good) AS g, sum(n) AS a, count(*) AS k FROM s GROUP BY f),
w AS (SELECT s.f, s.b, ln((good + 1) / (g + k)::DOUBLE) - ln((n - good + 1) / (a - g + k)::DOUBLE) AS odds FROM s JOIN o USING (f)),
e AS (SELECT rid, sum(coalesce(odds, 0)) AS e FROM (SELECT rid, unnest(x) AS b FROM (SELECT row_number() OVER () AS rid, x FROM g)) q
  LEFT JOIN w ON w.f = q.b.f AND w.b = q.b.b GROUP BY rid),
r AS (SELECT row_number() OVER () AS rid, * FROM g),
m AS (SELECT least(greatest(coalesce(avg(y), 0.5), 0.001), 0.999) AS m FROM g),
z AS (SELECT r.doc_id, h, p, held_out, e.e, coalesce(y::DOUBLE, 1 / (1 + exp(-(ln(m / (1 - m)) + e.e)))) AS q FROM r JOIN e USING (rid), m),
pa AS (SELECT h, p, sum(q) AS s, count(*) AS n FROM z GROUP BY ALL),
ho AS (SELECT h, sum(s) AS hs, sum(n) AS hn FROM pa GROUP BY h),
lv AS (SELECT sum(hs) / sum(hn) AS m, var_pop(hs / hn) AS v FROM ho),
lk AS (SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 10000 END, 1), 10000) AS k FROM lv),
hm AS (SELECT h, (hs + k * m) / (hn + k) AS host FROM ho, lk),
pm AS (SELECT pa.*, host FROM pa JOIN hm ON pa.h IS NOT DISTINCT FROM hm.h),
sv AS (SELECT avg(pow(s / n - host, 2)) AS v, avg(host) AS m FROM pm),
sk AS (SELECT least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 10000 END, 1), 10000) AS k FROM sv),
y AS (SELECT doc_id, held_out, e, host, (s + k * host) / (n + k) AS path,
    least(greatest((s - q + k * host) / (n - 1 + k), 0.001), 0.999) AS c
  FROM z JOIN pm ON z.h IS NOT DISTINCT FROM pm.h AND z.p IS NOT DISTINCT FROM pm.p, sk)
SELECT doc_id, held_out, round(e, 6) AS evidence, round(host, 6) AS host, round(path, 6) AS path,
  round(1 / (1 + exp(-(ln(c / (1 - c)) + e))), 6) AS score, 1 / (1 + exp(-(ln(c / (1 - c)) + e))) >= 0.5 AS kept FROM y
"""


def op3_neardup_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings with their near copies."""
    return near_vectors(table(spark, folder, "embeddings"), scratch(spark))


OP3 = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
sound AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id <= coalesce(b, vec_id) AS kept
FROM v LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
"""


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """As many tokens as there are, as evenly from all sources as repeating none more than twice allows."""
    rows = table(spark, folder, "documents").select("doc_id", "source", byte_tokens().alias("tokens"))
    return mixed(rows, scratch(spark), F.col("tokens"), budget="all", max_repeats=2.0).drop("tokens")


OP4 = """
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(source, '') AS s, strlen(coalesce(text, '')) // 4 + 1 AS tokens
  FROM documents),
src AS (SELECT s, sum(tokens)::BIGINT AS t, sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM d)::DOUBLE AS p FROM d GROUP BY s),
bisect(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, CASE WHEN (SELECT max(pow(p, -1)) / count(*) FROM src) <= 2.0 THEN 0.0 ELSE 1.0 END::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT i, lo, hi, (lo + hi) / 2 AS mid,
      (SELECT max(pow(p, (lo + hi) / 2 - 1)) / sum(pow(p, (lo + hi) / 2)) FROM src) <= 2.0 AS ok
    FROM bisect WHERE i < 30)),
x AS (SELECT hi AS x FROM bisect WHERE i = 30),
z AS (SELECT sum(pow(p, x)) AS z FROM src, x),
w AS (SELECT s, t, floor(round(t * (pow(p, x - 1) / z), 3))::BIGINT AS a FROM src, x, z),
q AS (SELECT s, t, a, a // t AS e, a % t AS r, (t + 4194303) // 4194304 AS n FROM w),
pl AS (SELECT d.*, ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % n AS b FROM d JOIN q USING (s)),
bl AS (SELECT s, b, sum(tokens)::BIGINT AS size FROM pl GROUP BY s, b),
ep AS (SELECT bl.*, q.t, q.a, q.e, q.r, unnest(range(0, q.e + 1)) AS k FROM bl JOIN q USING (s)),
o AS (SELECT *, row_number() OVER w AS bo, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) - size AS before FROM ep
  WINDOW w AS (PARTITION BY s, k ORDER BY md5('1:' || k || ':' || s || ':' || b), b)),
tu AS (SELECT *, CASE WHEN k < e THEN size ELSE r - before END AS lft FROM o),
m AS (SELECT doc_id, source, tokens, k, b, bo, md5('1:' || k || ':' || coalesce(doc_id::VARCHAR, '')) AS mo,
    round((k * t + before)::DOUBLE / a, 9) AS pr, lft, s FROM pl JOIN tu USING (s, b) WHERE lft > 0),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY s, b, k ORDER BY mo, tokens ROWS UNBOUNDED PRECEDING) AS cum FROM m)
SELECT doc_id, source, tokens AS mix_tokens, k::BIGINT AS mix_epoch, b AS mix_block, bo AS mix_block_order, mo AS mix_order,
  pr AS mix_progress FROM c WHERE cum <= lft
"""


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the bytes of strings of 200 bytes that also start elsewhere."""
    return without_repeats(table(spark, folder, "documents"), scratch(spark))


def op6_linededup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, with what is left of each."""
    rows = without_lines(table(spark, folder, "documents").select("doc_id", "text"), scratch(spark), further=True)
    return rows.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.octet_length("_kept").cast("bigint").alias("kept_bytes"),
        F.md5("_kept").alias("kept_md5"),
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, scored by a model of the labelled ones that are not held out."""
    documents = table(spark, folder, "documents")
    model = fitted(documents, table(spark, folder, "labels"))
    rows = scored(documents.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of all vectors for every hundredth id."""
    vectors = sound_vectors(table(spark, folder, "embeddings"))
    whole = vectors.select("vec_id", F.transform("v", lambda x: F.floor(1024 * x.cast("double")).cast("double")).alias("v"))
    return top_k(whole, whole.where("vec_id % 100 = 0"), 10, scratch(spark))


OP8 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their links at 85 percent of four-word shingles."""
    return jaccard_join(table(spark, folder, "documents"), scratch(spark), 4, 85)


OP9 = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM d),
t AS (SELECT doc_id, unnest(s) AS x FROM g),
n AS (SELECT doc_id, len(s) AS n FROM g),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a),
k AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT n.doc_id, n AS n_shingles, coalesce(k, 0) AS n_links, least(n.doc_id, coalesce(m.b, n.doc_id)) AS component_id
FROM n LEFT JOIN m ON m.a = n.doc_id LEFT JOIN k ON k.a = n.doc_id
"""


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as pieces of sequences of 2,048 tokens."""
    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packed(table(spark, folder, "documents"), scratch(spark), *map(str, files), public_tokenizers.PATTERN)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_quality": op2_quality,
    "op3_neardup_vectors": op3_neardup_vectors,
    "op4_mixing": op4_mixing,
    "op5_repeats": op5_repeats,
    "op6_linededup": op6_linededup,
    "op7_toxicity": op7_toxicity,
    "op8_topk": op8_topk,
    "op9_jaccard": op9_jaccard,
    "op10_packing": op10_packing,
}
ORACLES = {
    "op1_warc": OP1,
    "op2_quality": OP2,
    "op3_neardup_vectors": OP3, "op4_mixing": OP4, "op8_topk": OP8, "op9_jaccard": OP9}
