"""Calibrated score: model score and spending z-score, weighted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paywatch.functions.identity import user_key
from paywatch.operators.skew import join_lookup


def spending_spread(history: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the amounts of each user."""
    return (
        history.select(user_key(history.columns).alias("_user"), "amount")
        .where(F.col("_user").isNotNull())
        .groupBy("_user")
        .agg(F.avg("amount").alias("mean_amount"), F.stddev_samp("amount").alias("stddev_amount"))
    )


def zscore_score(
    df: DataFrame, spread: DataFrame, model_score: str, model_weight: float = 0.7, z_weight: float = 0.3, z_limit: float = 3.0
) -> DataFrame:
    """Add z_score (0 without history or spread) and final_score = weighted model score and |z| scaled to [0, 1]."""
    rows = join_lookup(df.withColumn("_user", user_key(df.columns)), spread, ["_user"])
    z = F.when(F.col("stddev_amount") > 0, (F.col("amount") - F.col("mean_amount")) / F.col("stddev_amount"))
    scaled = F.least(F.abs(F.col("z_score")), F.lit(z_limit)) / F.lit(z_limit)
    return (
        rows.withColumn("z_score", F.coalesce(z, F.lit(0.0)))
        .withColumn(
            "final_score", F.lit(model_weight) * F.coalesce(F.col(model_score), F.lit(0.0)) + F.lit(z_weight) * scaled
        )
        .select(*df.columns, "z_score", "final_score")
    )
