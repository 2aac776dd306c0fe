"""A corpus pipeline of five stages: from documents to packed sequences.

Each stage reads what its predecessor kept, and stores what it keeps. All but the last return the
columns of ``documents``. Columns beyond these five are dropped at the start.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, stored, table
from tidemark.llm.jaccard import jaccard_join
from tidemark.llm.linededup import without_lines
from tidemark.llm.mixing import byte_tokens, mixed
from tidemark.llm.packing import packed
from tidemark.llm.toxicity import fitted, scored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones does not find toxic."""
    docs = docs.select(*COLUMNS)
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).where("score < 0.5").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that align with an earlier one; those that lose all are copies and go."""
    rows = without_lines(docs.select(*COLUMNS), scratch(spark), further=True)
    left = F.trim(F.coalesce("_kept", F.lit(""))) != ""
    rows = rows.where((F.col("_n_removed") == 0) | left)
    rows = rows.withColumn("text", F.col("_kept"))
    length = F.when(F.col("_n_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))
    return rows.withColumn("n_chars", length.cast("bigint")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, at 80 percent of five-word shingles, the smallest id; null ids stay.

    Unlike texts under one id are documents of their own: the one with the smallest hash has the id as its
    key, each other one a key after all ids. Equal texts under one id are one document.
    """
    docs = docs.select(*COLUMNS)
    named = docs.where("doc_id is not null").select("*", F.xxhash64("text").alias("_text"))
    first = named.groupBy("doc_id").agg(F.min("_text").alias("_first"), F.max("_text").alias("_last"))
    first = first.where("_first <> _last").select("doc_id", "_first")
    other = F.xxhash64("doc_id", "_text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    key = F.when(F.col("_first").isNull() | (F.col("_text") == F.col("_first")), F.col("doc_id")).otherwise(other)
    folder = scratch(spark)
    keys = named.select("doc_id", "_text").distinct().join(first, "doc_id").select("doc_id", "_text", key.alias("_key"))
    keys = stored(keys.where("_key <> doc_id"), f"{folder}/keys")  # as many as ids with unlike texts have
    named = named.join(keys, ["doc_id", "_text"], "left").withColumn("_key", F.coalesce("_key", "doc_id"))
    found = jaccard_join(named.select(F.col("_key").alias("doc_id"), "text"), f"{folder}/join", 5, 80)
    found = found.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    order = Window.partitionBy("_key").orderBy("source", "lang", "n_chars")
    kept = named.join(found, "_key").withColumn("_nth", F.row_number().over(order)).where("_nth = 1")
    return kept.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The flattest mixture that has each document at least once and no source more than 1.5 times."""
    return mixed(docs.select(*COLUMNS), scratch(spark), byte_tokens(), max_repeats=1.5).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens."""
    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packed(docs, scratch(spark), *map(str, files), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: Three of the stages are no SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    folder = scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return docs
