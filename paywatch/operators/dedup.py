"""First-wins removal of repeated identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paywatch.operators.skew import BROADCAST_ROWS


def first_per_id(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of every id, by `order` and then by the remaining columns.

    A minimum over rows instead of a sort per id: it is taken before the shuffle too, so an id with a
    huge number of repeats costs one row per task. Rows without an id are never repeats.
    """
    ordered = [key, *order, *[c for c in df.columns if c not in {key, *order}]]
    first = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*[c for c in ordered if c != key])).alias("_first"))
        .select(key, "_first.*")
        .select(*df.columns)
    )
    return first.unionByName(df.where(F.col(key).isNull()))


def unseen(df: DataFrame, stored_ids: DataFrame, key: str, batch_rows: int | None = None) -> DataFrame:
    """Rows whose id is not stored yet; rows without an id always stay.

    The stored table is first reduced to the ids of this batch, reading one column of it. When the
    caller has counted the batch and it is small, its ids are broadcast and the stored side stays
    where it is; otherwise both sides meet by id.
    """
    batch_ids = df.where(F.col(key).isNotNull()).select(key).distinct()
    if batch_rows is not None and batch_rows <= BROADCAST_ROWS:
        batch_ids = F.broadcast(batch_ids)
    known = stored_ids.select(key).join(batch_ids, key, "left_semi").distinct()
    # rows without an id match nothing; in the join they would all meet in one task
    named = df.where(F.col(key).isNotNull()).join(known, key, "left_anti")
    return named.unionByName(df.where(F.col(key).isNull()))
