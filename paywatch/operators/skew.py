"""Lookups by a key of which one value may hold a third of all rows.

Spark's own skew handling splits a join input only when the sort sits directly on a shuffle, which is
not so when the lookup side is an aggregate. Here a heavy key is cut into slices instead: its rows
are spread over them and its single lookup row is repeated once per slice. At most `slices` keys can
be heavy, because each holds more than 1/slices of all rows, so the table of heavy keys is small
however large the data is, and at most 2 * slices lookup rows are added.

Heavy keys are found by one pre-aggregated pass over the key columns, or, where the lookup is made from the
same rows and so knows their number, while the lookup is written (`weigh`). Where there are none, which is
the usual case, the join stays an ordinary one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from paywatch.session import Scratch

SLICES = 2000
ROWS_PER_SLICE = 1_000_000

# A lookup of at most this many rows (an id and a few numbers each, some 20 MB) may go to every task.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Heavy:
    """Heavy keys with their slices (None: there are none), and whether rows without key need spreading."""

    table: DataFrame | None
    missing: bool
    slices: int


def all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def heavy_keys(
    rows: DataFrame, keys: Sequence[str], slices: int = SLICES, rows_per_slice: int = ROWS_PER_SLICE
) -> Heavy:
    """Keys with too many rows for one task and the number of slices each needs; fewer than `slices` keys."""
    seen = Observation()
    present = all_present(keys)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    counted = counts.observe(
        seen,
        F.sum("_rows").alias("total"),
        F.max(F.when(present, F.col("_rows"))).alias("largest"),
        F.sum(F.when(~present, F.col("_rows"))).alias("missing"),
    )
    # a key below the first `slices` counts cannot hold more than 1/slices of the rows
    top = Scratch(rows.sparkSession, "heavy").write(
        counted.where(present).orderBy(F.desc("_rows")).limit(slices), "counts"
    )
    share = max((seen.get["total"] or 0) / slices, rows_per_slice)
    table = None
    if (seen.get["largest"] or 0) > share:
        table = top.where(F.col("_rows") > share).select(
            *keys, F.ceil(F.col("_rows") / F.lit(float(share))).cast("int").alias("_slices")
        )
    return Heavy(table, (seen.get["missing"] or 0) > share, slices)


def weigh(
    lookup: DataFrame, keys: Sequence[str], weight: str, slices: int = SLICES, rows_per_slice: int = ROWS_PER_SLICE
) -> tuple[DataFrame, int, Heavy]:
    """Write a lookup that knows how many rows each key has; the lookup without `weight`, its size, its heavy keys.

    The rows themselves are not counted again. A lookup row with a missing key says how many rows lack one
    and goes no further.
    """
    present = all_present(keys)
    written, seen = Scratch(lookup.sparkSession, "lookup").write_with(
        lookup,
        "rows",
        total=F.sum(weight),
        largest=F.max(F.when(present, F.col(weight))),
        missing=F.sum(F.when(~present, F.col(weight))),
        size=F.count(F.lit(1)),
    )
    share = max((seen["total"] or 0) / slices, rows_per_slice)
    table = None
    if (seen["largest"] or 0) > share:
        table = written.where(present & (F.col(weight) > share)).select(
            *keys, F.ceil(F.col(weight) / F.lit(float(share))).cast("int").alias("_slices")
        )
    return written.where(present).drop(weight), seen["size"] or 0, Heavy(table, (seen["missing"] or 0) > share, slices)


def spread_hash(rows: DataFrame) -> Column:
    """A number that differs between the rows of a key: their columns (maps have no hash) and partition.

    The partition id keeps exact copies of a row apart; both inputs are stable when a task is retried.
    """
    hashable = [f.name for f in rows.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return F.xxhash64(*hashable, F.spark_partition_id())


def slice_rows(rows: DataFrame, keys: Sequence[str], heavy: Heavy) -> DataFrame:
    """Add the slice of each row. Rows without a key match nothing and may be spread over all slices."""
    if heavy.table is None and not heavy.missing:
        return rows.withColumn("_slice", F.lit(0))
    spread = rows.withColumn("_spread", spread_hash(rows))
    parts = F.lit(1)
    if heavy.table is not None:
        spread = spread.join(F.broadcast(heavy.table), list(keys), "left")
        parts = F.coalesce("_slices", F.lit(1))
    if heavy.missing:
        parts = F.when(all_present(keys), parts).otherwise(F.lit(heavy.slices))
    return spread.withColumn("_slice", F.pmod(F.col("_spread"), parts).cast("int")).select(*rows.columns, "_slice")


def slice_lookup(lookup: DataFrame, keys: Sequence[str], heavy: Heavy) -> DataFrame:
    """Repeat the lookup row of a heavy key once per slice."""
    if heavy.table is None:
        return lookup.withColumn("_slice", F.lit(0))
    return (
        lookup.join(F.broadcast(heavy.table), list(keys), "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
        .drop("_slices")
    )


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    slices: int = SLICES,
    rows_per_slice: int = ROWS_PER_SLICE,
    total_rows: int | None = None,
    count_from: DataFrame | None = None,
    lookup_rows: int | None = None,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Left join many rows to a lookup with one row per key.

    When the caller has counted the lookup and it is small, it is broadcast and no row moves. When the
    caller knows `total_rows` and they fit one slice, no key can be heavy and the join is plain.
    `count_from` is a cheaper table with the same keys in about the same proportions, such as the rows
    before earlier joins; heavy keys are then counted there. A loop that joins the same rows again and again
    finds its `heavy` keys once and passes them. Any proportions give right results.
    """
    keys = list(keys)
    if lookup_rows is not None and lookup_rows <= BROADCAST_ROWS:
        return rows.join(F.broadcast(lookup), keys, "left")
    if total_rows is not None and total_rows <= rows_per_slice:
        return rows.join(lookup, keys, "left")
    if heavy is None:
        heavy = heavy_keys(rows if count_from is None else count_from, keys, slices, rows_per_slice)
    if heavy.table is None and not heavy.missing:
        return rows.join(lookup, keys, "left")
    return (
        slice_rows(rows, keys, heavy)
        .join(slice_lookup(lookup, keys, heavy), [*keys, "_slice"], "left")
        .drop("_slice")
    )
