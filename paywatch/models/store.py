"""Model folders: versions of a fitted model, each next to a JSON file of what it was trained on.

The details are written last, so a version without them does not count: saving never touches the model that
others load, and a fit that is cut off leaves the former one in place.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from paywatch.models.isolation_forest import TREE_SCHEMA
from paywatch.sources.versions import complete_versions, delete_old, newest_version, next_version

KEEP = 3

REQUIRED = ("model_type", "feature_columns")


def _write_details(spark: SparkSession, details: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(details),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/details"
    )


def _newest(spark: SparkSession, path: str, model_type: str) -> tuple[str, dict]:
    version = newest_version(spark, path, "details")
    if version is None:
        raise FileNotFoundError(f"No model found at {path}. Train and save the model first.")
    details = json.loads(spark.read.text(f"{version}/details").first()[0])
    if any(name not in details for name in REQUIRED) or details["model_type"] != model_type:
        raise ValueError(f"Invalid model format at {path}.")
    return version, details


def _save(spark: SparkSession, path: str, details: dict, write) -> str:
    """A new version of the model that `write` puts into a folder; the oldest ones go."""
    found = complete_versions(spark, path, "details")
    version = next_version(found, path)
    write(f"{version}/model")
    _write_details(spark, details, version)
    delete_old(spark, found, KEEP)
    return version


def save_fraud_model(spark: SparkSession, model: PipelineModel, details: dict, path: str) -> str:
    return _save(spark, path, details, lambda folder: model.write().overwrite().save(folder))


def load_fraud_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    version, details = _newest(spark, path, "gbt")
    return PipelineModel.load(f"{version}/model"), details


def save_forest(spark: SparkSession, nodes: DataFrame, details: dict, path: str) -> str:
    return _save(spark, path, details, lambda folder: nodes.write.mode("overwrite").parquet(folder))


def load_forest(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    version, details = _newest(spark, path, "isolation_forest")
    return spark.read.schema(TREE_SCHEMA).parquet(f"{version}/model"), details
