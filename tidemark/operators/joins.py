"""A left join that holds when one key has very many rows on both sides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 10_000
MOST_HEAVY = 1_000
_TRACKED = 100_000


def _as_text(keys: Sequence[str]) -> Column:
    """A key as one text, different for different keys; null where a part of it is null, which equals nothing."""
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    whole = reduce(Column.__and__, (F.col(key).isNotNull() for key in keys))
    return F.when(whole, F.to_json(F.struct(*keys)))


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> dict[str, int]:
    """The keys with more rows than a part should have, as texts, and how many parts each asks for.

    A sketch of frequent items: one pass over the keys alone, its state of fixed size, no shuffle of
    rows. At most ``MOST_HEAVY`` keys come back. A key with more than one row in 75,000 is in the sketch for sure.
    """
    sketch = F.expr(f"approx_top_k(_key, {MOST_HEAVY}, {_TRACKED})").alias("top")
    found = df.select(_as_text(keys).alias("_key")).where("_key is not null").agg(sketch).first()["top"]
    return {each["item"]: -(-each["count"] // rows_per_part) for each in found or [] if each["count"] > rows_per_part}


def spread_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """``left.join(right, keys, "left")`` with the right rows of heavy keys spread over parts.

    Spark splits a heavy key of a left join on the left side only: all right rows of
    the key stay in one task. Here a sketch names the heavy keys first, see ``heavy_keys``; without
    any, this is the plain join. The right rows of a heavy key are dealt out in turn to as many
    parts as its count asks for, equal rows too, and each left row is copied to all parts of its
    key. Other keys have one part. The join reads ``right`` once, the sketch its keys; both must
    have the same keys: a stored table, or a plan whose every order is total. Keys are texts, whole
    numbers, times or dates.
    """
    keys = list(keys)
    heavy = heavy_keys(right, keys, rows_per_part)
    if not heavy:
        return left.join(right, keys, "left")
    facts = [column for column in right.columns if column not in keys]
    # at most MOST_HEAVY rows
    parts = F.broadcast(left.sparkSession.createDataFrame(list(heavy.items()), "_key string, _parts int"))
    known = [each.withColumn("_key", _as_text(keys)).join(parts, "_key", "left").drop("_key") for each in (left, right)]
    many = F.coalesce("_parts", F.lit(1))
    copies = known[0].withColumn("_part", F.explode(F.sequence(F.lit(0), many - 1)))
    turn = F.pmod(F.monotonically_increasing_id(), many).cast("int")
    dealt = known[1].withColumn("_part", turn).select(*keys, "_part", *facts, F.lit(True).alias("_met"))
    joined = copies.join(dealt, [*keys, "_part"], "left")
    # A copy in a part that got no row stands for nothing: a heavy key has rows in another.
    return joined.filter(F.col("_parts").isNull() | F.col("_met")).select(*left.columns, *facts)
