"""Supervised fraud model: boosted trees with weighted positives."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from paywatch.functions.values import clip01
from paywatch.models.boosting import DEEPEST, BoostedTrees
from paywatch.operators.features import schema_guard
from paywatch.operators.history import binary_target, feature_matrix, require_labels, resolve_target
from paywatch.settings import FEATURE_COLUMNS


def tasks_at_once(spark: SparkSession) -> int:
    """Tasks that the session surely runs side by side; 0 where executors come and go, as barrier stages are refused there."""
    context = spark.sparkContext
    if context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    scheduler = context._jsc.sc()
    slots = scheduler.maxNumConcurrentTasks(scheduler.resourceProfileManager().defaultResourceProfile())
    return min(slots, context.defaultParallelism)


def evenly(rows: DataFrame) -> DataFrame:
    """The rows in partitions of equal size, one per core.

    The tasks of a fit wait for each other at every level of every tree, so each level lasts as long as the fullest
    of them; rows that come from a small file may all lie in one.
    """
    spark = rows.sparkSession
    return rows.repartition(tasks_at_once(spark) or spark.sparkContext.defaultParallelism)


def _boosted(spark: SparkSession, features, trees, depth, rate, subsample, feature_share, seed):
    """Boosted trees fitted in one job; one job per level where that is not possible."""
    if tasks_at_once(spark) and 1 <= depth <= DEEPEST:
        return BoostedTrees(features, trees, depth, rate, subsample, feature_share, seed)
    return GBTClassifier(
        labelCol="_label",
        weightCol="_weight",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(feature_share),
        seed=seed,
    )


def train_fraud_model(
    df: DataFrame,
    target: str | None = None,
    features=FEATURE_COLUMNS,
    trees: int = 300,
    depth: int = 6,
    rate: float = 0.05,
    subsample: float = 0.9,
    feature_share: float = 0.8,
    seed: int = 42,
) -> tuple[PipelineModel, dict]:
    """Fit on rows with engineered features; the model and what is worth knowing about its training."""
    target = target or resolve_target(df.columns)
    labelled = binary_target(df, target, "_label")
    matrix = evenly(feature_matrix(labelled, tuple(features)).select("_label", *features)).persist()
    try:
        balance = require_labels(matrix, "_label")
        weight = float(balance["scale_pos_weight"])
        weighted = matrix.withColumn("_weight", F.when(F.col("_label") == 1, F.lit(weight)).otherwise(F.lit(1.0)))
        boosted = _boosted(df.sparkSession, features, trees, depth, rate, subsample, feature_share, seed)
        model = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), boosted]).fit(weighted)
    finally:
        matrix.unpersist()
    details = {
        "model_type": "gbt",
        "feature_columns": list(features),
        "target_column": target,
        "scale_pos_weight": weight,
        "total_samples": balance["total_samples"],
        "positive_samples": balance["positive_samples"],
        "negative_samples": balance["negative_samples"],
    }
    return model, details


def score_fraud(df: DataFrame, model: PipelineModel, features=FEATURE_COLUMNS, threshold: float = 0.5) -> DataFrame:
    """Add fraud_probability in [0, 1] and fraud_prediction; works on streams too."""
    schema_guard(df.columns, features, "fraud scoring", identity=False)
    originals = [F.col(c).alias(f"_raw_{c}") for c in features]
    matrix = feature_matrix(df.select("*", *originals), tuple(features))
    scored = model.transform(matrix).withColumn(
        "fraud_probability", clip01(vector_to_array("probability").getItem(1))
    )
    kept = [F.col(f"_raw_{c}").alias(c) if c in set(features) else F.col(c) for c in df.columns]
    return scored.select(
        *kept, "fraud_probability", (F.col("fraud_probability") >= threshold).cast("int").alias("fraud_prediction")
    )
