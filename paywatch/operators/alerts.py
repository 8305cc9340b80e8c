"""Alert rules, severities and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paywatch.functions.values import known
from paywatch.settings import Settings

# The fields of an alert message, in order.
MESSAGE_FIELDS = (
    "transaction_id",
    "user_id",
    "account_id",
    "merchant_id",
    "amount",
    "timestamp",
    "fraud_probability",
    "anomaly_score",
    "propagated_risk_score",
    "alert_reason",
    "alert_severity",
    "alert_timestamp",
)


def _signals(settings: Settings) -> dict[str, Column]:
    limits = {
        "fraud_probability": settings.alert_fraud_threshold,
        "anomaly_score": settings.alert_anomaly_threshold,
        "propagated_risk_score": settings.alert_propagated_threshold,
    }
    return {
        name: F.coalesce(known(F.col(name).try_cast("double")), F.lit(0.0)) >= F.lit(limit)
        for name, limit in limits.items()
    }


def alert_rules(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add alert_triggered and the reasons, in rule order."""
    signals = _signals(settings)
    reason = F.concat_ws(", ", *[F.when(hit, F.lit(name)) for name, hit in signals.items()])
    return df.withColumn("alert_reason", F.nullif(reason, F.lit(""))).withColumn(
        "alert_triggered", F.col("alert_reason").isNotNull()
    )


def alert_severity(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """High for enough signals at once, Medium for fraud or propagated risk, else Low; null without alert."""
    signals = _signals(settings)
    hits = sum((hit.cast("int") for hit in signals.values()), F.lit(0))
    return df.withColumn(
        "alert_severity",
        F.when(hits == 0, F.lit(None))
        .when(hits >= max(1, settings.alert_high_signal_count), "High")
        .when(signals["fraud_probability"] | signals["propagated_risk_score"], "Medium")
        .otherwise("Low"),
    )


def alert_timestamp(df: DataFrame, stamp: str) -> DataFrame:
    """One UTC stamp for the batch, on triggered rows only."""
    return df.withColumn("alert_timestamp", F.when(F.col("alert_triggered"), F.lit(stamp)))


def evaluate_alerts(df: DataFrame, stamp: str, settings: Settings = Settings()) -> DataFrame:
    return alert_timestamp(alert_severity(alert_rules(df, settings), settings), stamp)


def alert_batch_counts(df: DataFrame) -> DataFrame:
    """One row: records, alerts, and alerts per severity."""
    triggered = F.coalesce(F.col("alert_triggered"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(triggered).alias("total_alerts"),
        *[
            F.count_if(triggered & (F.col("alert_severity") == name)).alias(f"{name.lower()}_alerts")
            for name in ("Low", "Medium", "High")
        ],
    )


def alert_messages(df: DataFrame) -> DataFrame:
    """Triggered rows as keyed JSON: twelve fields, unknown as null, plus alert_triggered for the consumer."""
    fields = []
    for name in MESSAGE_FIELDS:
        value = F.col(name)
        if df.schema[name].dataType.typeName() in ("double", "float"):
            value = known(value)
        fields.append(value.alias(name))
    body = F.struct(*fields, F.lit(True).alias("alert_triggered"))
    # without an id the message gets the shared fallback key
    key = F.when(F.coalesce(F.trim("transaction_id"), F.lit("")) != "", F.trim("transaction_id")).otherwise("unknown")
    return df.where(F.coalesce(F.col("alert_triggered"), F.lit(False))).select(
        key.alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value")
    )
