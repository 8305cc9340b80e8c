"""Sliding-window enrichment of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paywatch.functions.identity import user_key
from paywatch.operators.features import base_features
from paywatch.operators.history import HISTORY_KEY
from paywatch.operators.skew import BROADCAST_ROWS, spread_hash
from paywatch.settings import Settings

# A stream cannot count its keys beforehand, so every key of a window is cut into up to this many slices (63 at most).
STREAM_SLICES = 8


def _per_slice(aggregate: DataFrame, slices: int) -> DataFrame:
    return aggregate.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))


def _slice_of(parsed: DataFrame, slices: int) -> Column:
    """Slice of a row by its own columns alone, so that every branch of the stream finds the same one."""
    hashable = [f.name for f in parsed.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return F.pmod(F.xxhash64(*hashable), F.lit(slices)).cast("int")


def _seen_slices() -> Column:
    """The slices that the rows of a key fall into, one bit each."""
    return F.bit_or(F.expr("shiftleft(1L, _slice)")).alias("_slices")


def _per_seen_slice(aggregate: DataFrame, slices: int) -> DataFrame:
    """An aggregate once per slice that has rows of its key; most keys have one row or two, and join state keeps each copy."""
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    return aggregate.withColumn("_slice", F.explode(every)).where("getbit(_slices, _slice) = 1").drop("_slices")


def window_enrich_stream(parsed: DataFrame, settings: Settings = Settings(), slices: int = STREAM_SLICES) -> DataFrame:
    """Streaming form of the window enrichment, in append mode.

    Rows carry their window as the only event-time column (`event_timestamp` continues as a plain
    copy), because a join accepts one watermarked column per side. A row comes out, once per window,
    when the watermark has passed the end of that window.
    """
    prepared = base_features(parsed, settings).withWatermark("event_timestamp", settings.watermark_delay)

    def slot():
        return F.window("event_timestamp", settings.window_duration, settings.slide_duration)

    plain = F.timestamp_micros(F.unix_micros("event_timestamp"))
    prepared = prepared.withColumn("_slice", _slice_of(parsed, slices))
    rows = prepared.withColumns({"feature_window": slot(), "_plain": plain})
    rows = rows.drop("event_timestamp").withColumnRenamed("_plain", "event_timestamp")

    users = (
        prepared.where(F.col("user_agg_key").isNotNull())
        .groupBy(slot().alias("u_window"), F.col("user_agg_key").alias("u_key"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count_per_user"),
            F.sum("amount").alias("total_amount_per_user"),
            F.avg("amount").alias("avg_amount_per_user"),
            _seen_slices(),
        )
    )
    merchants = (
        prepared.where(F.col("merchant_agg_key").isNotNull())
        .groupBy(slot().alias("m_window"), F.col("merchant_agg_key").alias("m_key"))
        .agg(F.count(F.lit(1)).alias("transaction_count_per_merchant"), _seen_slices())
    )
    users = _per_seen_slice(users, slices).withColumnRenamed("_slice", "u_slice")
    merchants = _per_seen_slice(merchants, slices).withColumnRenamed("_slice", "m_slice")
    return (
        rows.join(
            users,
            (F.col("feature_window") == F.col("u_window"))
            & (F.col("user_agg_key") == F.col("u_key"))
            & (F.col("_slice") == F.col("u_slice")),
            "left",
        )
        .join(
            merchants,
            (F.col("feature_window") == F.col("m_window"))
            & (F.col("merchant_agg_key") == F.col("m_key"))
            & (F.col("_slice") == F.col("m_slice")),
            "left",
        )
        .drop("u_window", "u_key", "u_slice", "m_window", "m_key", "m_slice", "_slice")
        .withColumns({"window_start": F.col("feature_window.start"), "window_end": F.col("feature_window.end")})
    )


def history_enrich_stream(enriched: DataFrame, profile: DataFrame, slices: int = STREAM_SLICES) -> DataFrame:
    """Attach the historical profile to a stream.

    `profile` should be a stored table, refreshed on purpose, so that no micro-batch aggregates the
    history again. Its size is checked here: a small one is broadcast, a larger one is joined by key
    and slice.
    """
    keyed = enriched.withColumn(HISTORY_KEY, user_key(enriched.columns))
    if profile.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return keyed.join(F.broadcast(profile), HISTORY_KEY, "left")
    sliced = keyed.withColumn("_slice", F.pmod(spread_hash(keyed), F.lit(slices)).cast("int"))
    return sliced.join(_per_slice(profile, slices), [HISTORY_KEY, "_slice"], "left").drop("_slice")
