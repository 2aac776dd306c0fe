"""Exact top-k by integer inner product, in three phases with a uniform threshold.

A vector's components are cut into slices; a slice's list of a candidate block holds each
candidate's part of the score. The whole score is the sum of its slices' parts, so a score of at
least t has a part of at least t / slices in some list.

1. Each block sends, per query, the best whole scores among the leaders of its lists. The k-th
   best of all that arrive is a safe cutoff: so many candidates reach it for certain.
2. The cutoffs go back to the blocks, which collect every entry whose part reaches the cutoff
   over the number of slices, in any list.
3. Collected entries that can still reach the cutoff are resolved: their parts are summed
   exactly, and each block sends its best k at or above the cutoff.

Queries meet candidates in blocks of both; each block of queries with its cutoffs goes to the
tasks as rows of a join on the block number, so nothing is broadcast whole. A block sends at
most k entries per query in either phase, also where a third of all vectors are equal.

Null vectors, and vectors that hold null or non-finite components, take no part. Vectors of
another length than the query's are no candidates of it. Query rows that repeat an id are one
query: the vector that is smallest, as arrays compare, stands for it. Candidate rows are taken as
they are, but never the query's own id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

_FOUND = "query_id bigint, vec_id bigint, score bigint"


def sound_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Key and vector of the rows whose vectors are whole and finite. Floats stay floats, other numbers become doubles."""
    kind = "array<float>" if dict(vectors.dtypes)[column] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(column).cast(kind).alias("v"))
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~broken)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best: highest score, then smallest id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _scan(k: int, slices: int, collect: bool):
    """The work on one pair of blocks, for the first phase or the other two."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        for size, queries in left.groupby(left["v"].map(len), sort=False):
            own = right[right["v"].map(len) == size]
            if not len(own):
                continue
            c, ids = np.stack(own["v"].to_numpy()), own["vec_id"].to_numpy()
            q, names = np.stack(queries["v"].to_numpy()), queries["vec_id"].to_numpy()
            cuts = np.array_split(np.arange(size), min(slices, size))
            parts = np.stack([q[:, x] @ c[:, x].T for x in cuts])  # list, query, candidate
            for i, name in enumerate(names.tolist()):
                part = parts[:, i]
                if collect:
                    cutoff = queries["cutoff"].iloc[i]
                    wanted = (part >= cutoff / len(cuts)).any(axis=0)  # phase 2
                    # a list in which an entry was not collected adds less than the threshold
                    reach = np.maximum(part, cutoff / len(cuts)).sum(axis=0) >= cutoff
                    some = np.flatnonzero(wanted & reach & (ids != name))
                    total = part[:, some].sum(axis=0)  # phase 3
                    some, total = some[total >= cutoff], total[total >= cutoff]
                else:
                    leaders = [_best(p, ids, k + 1) for p in part]
                    some = np.unique(np.concatenate(leaders))
                    some = some[ids[some] != name]
                    total = part[:, some].sum(axis=0)
                for at in _best(total, ids[some], k).tolist():
                    out.append((name, int(ids[some[at]]), int(total[at])))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, folder: str, slices: int = 4, block: int = 4096) -> DataFrame:
    """For each query the k highest scores among the vectors: query_id, rank, vec_id, score.

    Both frames have vec_id and integer components ``v``, whose products must stay below 2**53.
    """
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_queries, n_vectors = asked.count(), vectors.count()
    across, down = max(1, -(-n_queries // 512)), max(1, -(-n_vectors // block))
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(across)).cast("int")
    asked = stored(asked.withColumn("q", spread), f"{folder}/queries")
    # candidates of one id may be many rows: dealt by row, not by id
    dealt = F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id()), F.lit(down)).cast("int")
    cells = stored(vectors.withColumn("c", dealt), f"{folder}/candidates").withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))
    )
    columns = F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("c")

    def scan(asked: DataFrame, collect: bool) -> DataFrame:
        left = asked.select("*", columns).groupBy("q", "c")
        return left.cogroup(cells.groupBy("q", "c")).applyInPandas(_scan(k, slices, collect), _FOUND)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    leaders = scan(asked, False).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    reached = leaders.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    cutoff = F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf")))
    reached = reached.select(F.col("query_id").alias("vec_id"), cutoff.alias("cutoff"))
    asked = stored(asked.join(reached, "vec_id"), f"{folder}/cutoffs")
    found = scan(asked, True).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
