"""Mixing sources to target weights by temperature, with DataFrame functions only.

The token shares p of the sources are raised to an exponent t and normalised: t = 1 keeps the natural
mix, t = 0 gives all sources the same weight. The exponent is bisected to the flattest mix that repeats
no source more often than a limit, or to the mix of a wanted entropy. A token budget then gives every
source a number of epochs; each epoch is a permutation of the source's documents by a hash, the last one
stops at the budget. Sources advance evenly through a sequence of blocks, and inside a block the
documents of all sources are permuted.

Places in an epoch are running token sums over one source, of which one may hold a third of all rows.
They are taken in two steps: sums over short ranges of the hash, run up over the ranges, and then inside
each range, so no task orders more than a range or a list of ranges.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, Window, functions as F

from paywatch.llm.common import parts_for
from paywatch.operators.skew import join_lookup
from paywatch.session import Scratch

MAX_REPEATS = 4.0
BLOCK_TOKENS = 200_000
RANGE_ROWS = 5_000
STEPS = 40
WORDS = "[^ \\t\\n\\u000b\\f\\r]+"


def _bisect(low: float, high: float, goes_up: Callable[[float], bool]) -> float:
    """`goes_up(t)`: whether the answer lies at t or above."""
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if goes_up(middle) else (low, middle)
    return high


def temperature(sources: DataFrame, max_repeats: float = MAX_REPEATS, target_entropy: float | None = None, budget: int | None = None) -> float:
    """The exponent for sources with `tokens` > 0 and their `share`.

    With `target_entropy` (in nats) the mix has that entropy; it can't exceed that of equal weights nor
    fall below the natural mix. Otherwise no source may be repeated over `max_repeats` times, where
    without a budget the source with the fewest repeats is shown once.
    """

    def power(t: float) -> Column:
        return F.pow(F.col("share"), F.lit(t))

    def entropy_above(t: float) -> bool:
        z, e = sources.agg(F.sum(power(t)), F.sum(power(t) * F.log("share"))).first()
        # of weights share^t / z
        return log(z) - t * e / z > target_entropy

    def too_often(t: float) -> bool:
        rate = power(t) / F.col("tokens")
        z, most, least = sources.agg(F.sum(power(t)), F.max(rate), F.min(rate)).first()
        repeats = most / least if budget is None else budget * most / z
        return repeats > max_repeats * (1 + 1e-12)

    test = too_often if target_entropy is None else entropy_above
    if not test(0.0):
        return 0.0
    if target_entropy is None and test(1.0):
        raise ValueError("The budget alone repeats all sources more often than the limit.")
    return _bisect(0.0, 1.0, test)


def mixture(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget: int | None = None,
    max_repeats: float = MAX_REPEATS,
    target_entropy: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document and epoch: key, source, epoch, block, place, n_tokens, weight.

    Tokens are words between ASCII white space. Without a `budget` it is the smallest that shows every
    document; a smaller one leaves out the ends of permutations. A missing source is a source of its
    own; a missing text has no tokens. Documents without tokens follow their source; a source without
    any tokens has weight zero and is left out. Repeated rows are documents of their own; an empty
    table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    # "=" keeps a missing source apart from an empty one
    sized = scratch.write(
        docs.select(
            F.col(key).cast("long").alias("key"),
            F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("source"),
            F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("tokens"),
        ),
        "sized",
    )
    totals, seen = scratch.write_with(
        sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).where("tokens > 0"),
        "totals",
        tokens=F.sum("tokens"),
        sources=F.count(F.lit(1)),
    )
    shares = scratch.write(totals.withColumn("share", F.col("tokens") / F.lit(float(seen["tokens"] or 1))), "shares")
    t = temperature(shares, max_repeats, target_entropy, budget) if seen["sources"] else 1.0
    plan = _plan(shares, t, budget)
    plan, sums = scratch.write_with(plan, "plan", target=F.sum("target"))
    blocks = parts_for(sums["target"], block_tokens)

    # one row per document and epoch, at a hash that orders the epoch
    shown = join_lookup(sized, plan, ["source"], lookup_rows=seen["sources"] or 0).where(F.col("target").isNotNull())
    last = F.col("full") + F.when(F.col("rest") > 0, 1).otherwise(0)
    drawn = shown.withColumn("epoch", F.explode(F.when(last > 0, F.sequence(F.lit(1).cast("long"), last))))
    name = F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("epoch").cast("string"))
    drawn = drawn.withColumn("_h", F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long"))
    ranges = F.ceil(F.col("rows") / F.lit(float(RANGE_ROWS)))
    drawn = drawn.withColumn("_range", F.floor(F.col("_h") / F.lit(float(1 << 60)) * ranges).cast("long"))

    group = ["source", "epoch", "_range"]
    run = Window.partitionBy("source", "epoch").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = drawn.groupBy(*group).agg(F.sum("tokens").alias("_sum")).select(
        *group, F.coalesce(F.sum("_sum").over(run), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*group).orderBy("_h", "key", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    placed = drawn.withColumn("_inside", F.sum("tokens").over(inside)).join(offsets, group)
    placed = placed.withColumn("_end", F.col("_offset") + F.col("_inside"))
    placed = placed.where((F.col("epoch") <= F.col("full")) | (F.col("_end") <= F.col("rest")))

    passed = (F.col("epoch") - 1) * F.col("source_tokens") + F.col("_end") - F.col("tokens")
    block = F.least(F.floor(passed.cast("double") / F.col("target").cast("double") * blocks), F.lit(blocks - 1)).cast("long")
    order = Window.partitionBy("block").orderBy("_h", "key", "epoch", "tokens")
    return placed.withColumn("block", block).select(
        F.col("key").alias(key),
        F.when(F.col("source") != "", F.substring("source", 2, 1 << 30)).alias(source),
        "epoch",
        "block",
        F.row_number().over(order).cast("long").alias("place"),
        F.col("tokens").alias("n_tokens"),
        "weight",
    )


def _plan(shares: DataFrame, t: float, budget: int | None) -> DataFrame:
    """Per source its weight, whole epochs, tokens of the last epoch, and all its tokens in the mixture."""
    power = F.pow(F.col("share"), F.lit(t))
    z, least = shares.agg(F.sum(power), F.min(power / F.col("tokens"))).first()
    z, least = z or 1.0, least or 1.0
    repeats = power / F.col("tokens") / F.lit(least) if budget is None else F.lit(float(budget)) * power / F.lit(z) / F.col("tokens")
    # a rounding error must not cost a document its only showing
    return (
        shares.withColumn("repeats", F.round(repeats, 9))
        .withColumn("full", F.floor("repeats").cast("long"))
        .withColumn("rest", F.floor((F.col("repeats") - F.col("full")) * F.col("tokens")).cast("long"))
        .select(
            "source",
            "rows",
            F.col("tokens").alias("source_tokens"),
            "full",
            "rest",
            (F.col("full") * F.col("tokens") + F.col("rest")).alias("target"),
            F.round(power / F.lit(z), 9).alias("weight"),
        )
    )
