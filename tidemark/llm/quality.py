"""Quality: hierarchical empirical Bayes over documents, hosts and paths.

A naive Bayes classifier of text-shape features, learned from labelled documents, gives each
document its evidence: the log of how much likelier its features are among good documents. Hosts
and the paths within them then get posteriors by grouped aggregation: the share of good documents
of a host is pulled towards the global share, that of a path towards its host's, the more the
fewer documents it has. How strongly is estimated from the spread of the shares (method of
moments). A document's prior is its path's posterior without itself; its score adds the evidence.

Labelled documents whose hash leaves 0 when divided by 5 are held out: their labels count nowhere.
Null hosts and paths are groups like any other. Null text has the features of empty text. Labels
that are null, or neither 0 nor 1, are not used; an id with several counts with the smallest. With
no labels all evidence is 0 and the global share is one half. Rows that repeat an id are scored
each. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

FEATURES = {
    "symbols": "least(7, floor(32D * (n - length(translate(t, '#$%&*|!', ''))) / (n + 1)))",
    "capitals": "least(7, floor(8D * (n - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) / (n + 1)))",
    "size": "length(bin(n))",
    "word": "least(15, floor(n / (1D + n - length(replace(t, ' ', '')))))",
    "line": "length(bin(cast(floor(n / (1D + n - length(replace(t, '\\n', '')))) as bigint)))",
    "varied": "floor(8D * size(array_distinct(split(t, ' '))) / size(split(t, ' ')))",
}
_LEAST, _MOST = 1.0, 10_000.0


def held_out(key: str = "doc_id") -> Column:
    digest = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % 5 == 0


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(share: float | None, spread: float | None) -> float:
    """How many documents the level above is worth."""
    if not spread:
        return _MOST
    return min(max(share * (1 - share) / spread - 1, _LEAST), _MOST)


def quality(documents: DataFrame, labels: DataFrame, folder: str, host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, host and path of each document, with held_out, evidence, host_share, path_share and score."""
    bins = F.array(*[F.struct(F.lit(k).alias("feature"), F.expr(v).cast("int").alias("bin")) for k, v in FEATURES.items()])
    shaped = documents.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), "text")
    shaped = shaped.withColumn("t", F.coalesce("text", F.lit(""))).withColumn("n", F.length("t"))
    shaped = shaped.select("doc_id", "host", "path", bins.alias("bins"), held_out().alias("held_out"))
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"))
    known = known.where(~held_out()).withColumnRenamed("doc_id", "known_id")
    # texts are read once; what follows works on a few numbers for each document
    tagged = shaped.join(known, F.col("doc_id") == F.col("known_id"), "left").drop("known_id")
    tagged = stored(tagged, f"{folder}/tagged")

    seen = tagged.where("label is not null").select("label", F.explode("bins").alias("b"))
    # one row for each feature and bin: a few dozen, whatever the data
    seen = seen.groupBy("b.feature", "b.bin").agg(F.sum("label").alias("good"), F.count("*").alias("all")).collect()
    good, bad, bins_of = Counter(), Counter(), Counter()
    for r in seen:
        good[r["feature"]] += r["good"]
        bad[r["feature"]] += r["all"] - r["good"]
        bins_of[r["feature"]] += 1
    evidence = F.lit(0.0)
    if seen:
        entries: list[Column] = []
        for r in sorted(seen):
            f, k = r["feature"], bins_of[r["feature"]]
            odds = math.log((r["good"] + 1) / (good[f] + k)) - math.log((r["all"] - r["good"] + 1) / (bad[f] + k))
            entries += [F.lit(f"{f}:{r['bin']}"), F.lit(odds)]
        odds_of = F.create_map(*entries)
        evidence = F.aggregate(
            "bins",
            F.lit(0.0),
            lambda s, b: s + F.coalesce(F.try_element_at(odds_of, F.concat_ws(":", b["feature"], b["bin"])), F.lit(0.0)),
        )
    share = tagged.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
    share = min(max(share, 0.001), 0.999)
    scored = tagged.withColumn("evidence", evidence)
    chance = _sigmoid(F.lit(math.log(share / (1 - share))) + F.col("evidence"))
    scored = scored.withColumn("chance", F.coalesce(F.col("label").cast("double"), chance)).drop("bins", "label")

    paths = scored.groupBy("host", "path").agg(F.sum("chance").alias("s"), F.count("*").alias("n"))
    paths = stored(paths, f"{folder}/paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    level = hosts.agg(F.sum("hs") / F.sum("hn"), F.var_pop(F.col("hs") / F.col("hn"))).first()
    k = _strength(*level)
    pulled = (F.col("hs") + F.lit(k * (level[0] or 0.0))) / (F.col("hn") + F.lit(k))
    paths = _joined(paths, hosts.select("host", pulled.alias("host_share")), ["host"])
    level = paths.agg(F.avg("host_share"), F.avg(F.pow(F.col("s") / F.col("n") - F.col("host_share"), 2))).first()
    k = F.lit(_strength(*level))
    both = _joined(scored, paths, ["host", "path"])
    others = (F.col("s") - F.col("chance") + k * F.col("host_share")) / (F.col("n") - 1 + k)
    others = F.least(F.greatest(others, F.lit(0.001)), F.lit(0.999))
    return both.select(
        "doc_id",
        "host",
        "path",
        "held_out",
        "evidence",
        "host_share",
        ((F.col("s") + k * F.col("host_share")) / (F.col("n") + k)).alias("path_share"),
        _sigmoid(F.ln(others / (1 - others)) + F.col("evidence")).alias("score"),
    )


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which nulls are equal; keeps the keys of the left side."""
    right = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
    return left.join(right, same).drop(*[f"r_{k}" for k in keys])
