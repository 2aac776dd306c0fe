"""Temperature mixing of sources, with DataFrame functions only.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources
alike) and 1 (as found), normalised. The exponent is bisected: either to the flattest mixture that
repeats no source more often than a limit, or to the most natural one whose entropy reaches a
target. One pass evaluates the 31 points of five bisection steps, so the table of sources is
never gathered.

The weights are then realised within a budget of tokens. Each source's rows are dealt to blocks
by a hash; an epoch is a permutation of its blocks, and of the rows within each. A source gets as
many whole epochs as its tokens allow, and of one more the blocks that fit the rest, the last of
them in part. Running sums therefore go over blocks, of about equal size, and over the rows of
one block for each source: never over all rows of a large source.

With ``budget=None`` the budget is as large as it takes to have every row at least once, so
nothing is dropped. Null and empty sources are one source; null keys and texts are rows like any
other. Rows that repeat a key keep together in a block. No rows: no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

_STEPS, _PASSES = 32, 6


def byte_tokens(text: str = "text") -> Column:
    """A cheap count of tokens: one for every four bytes begun, one at least."""
    return F.expr(f"octet_length(coalesce({text}, '')) div 4 + 1").cast("bigint")


def _number(*parts: Column) -> Column:
    """32 bits of the MD5 of parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def exponent(sources: DataFrame, budget: float | None, max_repeats: float | None, min_entropy: float | None) -> float:
    """The exponent for sources (p: share of all tokens).

    ``budget`` is in units of all tokens. ``min_entropy`` is a share of the largest entropy.
    """
    low, high = 0.0, 1.0
    for turn in range(_PASSES):
        width = (high - low) / _STEPS
        points = [low + width * i for i in range(_STEPS + 1)]
        x = F.explode(F.array(*map(F.lit, points))).alias("x")
        power = F.pow("p", "x")
        rows = (
            sources.select("p", x)
            .groupBy("x")
            .agg(
                F.sum(power).alias("z"),
                F.sum(power * F.ln("p")).alias("zl"),
                F.max(F.pow("p", F.col("x") - 1)).alias("most"),
                F.min(F.pow("p", F.col("x") - 1)).alias("least"),
                F.count("*").alias("n"),
            )
        )
        if max_repeats is not None:
            repeats = F.col("most") / F.col("least") if budget is None else F.col("most") * budget / F.col("z")
            holds = repeats <= max_repeats
        else:
            holds = F.ln("z") - F.col("x") * F.col("zl") / F.col("z") >= min_entropy * F.ln("n")
        held = {r["x"]: r["holds"] for r in rows.select("x", holds.alias("holds")).collect()}
        if not held:
            return 1.0
        if max_repeats is not None:  # holds from some point upwards: the smallest is wanted
            if turn == 0 and held[low]:
                return low
            at = next((i for i in range(1, _STEPS + 1) if held[points[i]]), _STEPS)
        else:  # holds up to some point: the largest is wanted
            if turn == 0 and held[high]:
                return high
            at = next((i for i in range(1, _STEPS + 1) if not held[points[i]]), _STEPS)
        low, high = points[at - 1], points[at]
    return high if max_repeats is not None else low


def mixed(
    rows: DataFrame,
    folder: str,
    tokens: Column,
    budget: int | str | None = None,
    max_repeats: float | None = None,
    min_entropy: float | None = None,
    key: str = "doc_id",
    source: str = "source",
    block_tokens: int = 1 << 22,
    seed: int = 1,
) -> DataFrame:
    """The rows of the mixture, with all columns and six more, named with a leading ``mix_``.

    No column of the rows may have such a name.

    mix_tokens; mix_epoch, from 0; mix_block; mix_block_order, the block's place in its source's
    epoch; mix_order, by which rows of a block are ordered; mix_progress, how far into its
    source's budget the block begins, by which sources interleave.

    Give ``max_repeats`` or ``min_entropy``. ``budget``: tokens, or "all" for as many as there are.
    """
    if (max_repeats is None) == (min_entropy is None):
        raise ValueError("give a limit of repeats or a target entropy")
    start = F.lit(str(seed))
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    known = rows.withColumn("mix_source", name).withColumn("mix_tokens", tokens)
    found = known.groupBy("mix_source").agg(F.sum("mix_tokens").alias("t"))
    found = stored(found, f"{folder}/found")
    total = found.agg(F.sum("t")).first()[0] or 0
    shares = found.withColumn("p", F.col("t") / F.lit(float(total or 1)))
    if isinstance(budget, int):
        share = budget / (total or 1)
    else:
        share = 1.0 if budget == "all" else None
    x = F.lit(exponent(shares, share, max_repeats, min_entropy))
    z, least = shares.agg(F.sum(F.pow("p", x)), F.min(F.pow("p", x - 1))).first()
    # of each token of a source, so many come into the mixture
    repeats = F.pow("p", x - 1) * F.lit(share or 1.0) / F.lit(z or 1.0)
    if share is None:
        repeats = F.pow("p", x - 1) / F.lit(least or 1.0)
    sources = shares.withColumn("allotted", F.floor(F.round(F.col("t") * repeats, 3)).cast("bigint")).select(
        "mix_source",
        "t",
        "allotted",
        F.expr("allotted div t").alias("epochs"),
        F.expr("allotted % t").alias("rest"),
        F.expr(f"(t + {block_tokens - 1}) div {block_tokens}").alias("mix_blocks"),
    )
    sources = stored(sources, f"{folder}/sources")
    number = F.pmod(_number(start, F.coalesce(F.col(key).cast("string"), F.lit(""))), F.col("mix_blocks"))
    placed = known.join(sources.select("mix_source", "mix_blocks"), "mix_source").withColumn("mix_block", number)
    placed = placed.drop("mix_blocks")

    sizes = placed.groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("size"))
    turns = sizes.join(sources, "mix_source").withColumn("mix_epoch", F.explode(F.expr("sequence(0L, epochs)")))
    order = F.md5(F.concat_ws(":", start, F.col("mix_epoch"), F.col("mix_source"), F.col("mix_block")))
    epoch = Window.partitionBy("mix_source", "mix_epoch").orderBy("o", "mix_block")
    turns = turns.withColumn("o", order).select(
        "*",
        F.row_number().over(epoch).cast("bigint").alias("mix_block_order"),
        (F.sum("size").over(epoch.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("before"),
    )
    left = F.when(F.col("mix_epoch") < F.col("epochs"), F.col("size")).otherwise(F.col("rest") - F.col("before"))
    turns = turns.withColumn("mix_left", left).where("mix_left > 0")
    progress = (F.col("mix_epoch") * F.col("t") + F.col("before")) / F.col("allotted")
    turns = turns.select(
        "mix_source",
        "mix_block",
        "mix_epoch",
        "mix_block_order",
        F.round(progress, 9).alias("mix_progress"),
        "mix_left",
        (F.col("mix_left") < F.col("size")).alias("mix_part"),
    )
    turns = stored(turns, f"{folder}/turns")

    own = F.md5(F.concat_ws(":", start, F.col("mix_epoch"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    met = placed.join(turns.where("not mix_part"), ["mix_source", "mix_block"]).withColumn("mix_order", own)
    cut = placed.join(turns.where("mix_part"), ["mix_source", "mix_block"]).withColumn("mix_order", own)
    within = Window.partitionBy("mix_source", "mix_block", "mix_epoch").orderBy("mix_order", "mix_tokens")
    within = within.rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("mix_sum", F.sum("mix_tokens").over(within)).where(F.col("mix_sum") <= F.col("mix_left")).drop("mix_sum")
    return met.unionByName(cut).drop("mix_source", "mix_left", "mix_part")
