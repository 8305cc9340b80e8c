"""The whole way from `Settings`: train both models, keep the profile table, run the scoring stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from paywatch.functions.identity import user_key
from paywatch.models import fraud, isolation_forest, store
from paywatch.operators.history import HISTORY_KEY, historical_profile, training_features
from paywatch.operators.skew import join_lookup
from paywatch.session import Scratch
from paywatch.settings import Settings
from paywatch.sources.versions import complete_versions, delete_old, newest_version, next_version
from paywatch.streaming.enrich import window_enrich_stream
from paywatch.streaming.scoring import BatchProcessor, start_stream


def train_models(history: DataFrame, settings: Settings = Settings(), **fraud_options) -> None:
    """Fit both models on a table of labelled transactions and store them where the settings say."""
    spark = history.sparkSession
    rows = Scratch(spark, "training").write(training_features(history, settings), "features")
    model, details = fraud.train_fraud_model(rows, **fraud_options)
    store.save_fraud_model(spark, model, details, settings.fraud_model_path)
    nodes, details = isolation_forest.train_isolation_forest(rows, "transaction_id", contamination=settings.anomaly_contamination)
    store.save_forest(spark, nodes, details, settings.anomaly_model_path)


def refresh_profile(history: DataFrame, settings: Settings = Settings(), keep: int = 2) -> DataFrame:
    """A new version of the historical profile; running streams look it up with their next micro-batch.

    The `keep` newest versions stay, so a micro-batch that reads the former one still finds its files.
    """
    spark = history.sparkSession
    found = complete_versions(spark, settings.profile_path)
    path = next_version(found, settings.profile_path)
    historical_profile(history).write.mode("overwrite").parquet(path)
    delete_old(spark, found, keep)
    return spark.read.parquet(path)


def latest_profile(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """The newest complete version of the profile."""
    path = newest_version(spark, settings.profile_path)
    if path is None:
        raise FileNotFoundError(f"No profile found at {settings.profile_path}. Run refresh_profile first.")
    return spark.read.parquet(path)


def batch_scorer(spark: SparkSession, settings: Settings = Settings()) -> Callable[[DataFrame], DataFrame]:
    """History features and both scores for the micro-batches of a stream.

    Models are loaded once, the profile is looked up for each batch. How the profile is joined follows from its
    size at that time, which its Parquet footers tell, and from the users of the batch.
    """
    model, _ = store.load_fraud_model(spark, settings.fraud_model_path)
    nodes, details = store.load_forest(spark, settings.anomaly_model_path)

    def score(batch: DataFrame) -> DataFrame:
        profile = latest_profile(batch.sparkSession, settings)
        keyed = batch.withColumn(HISTORY_KEY, user_key(batch.columns))
        enriched = join_lookup(keyed, profile, [HISTORY_KEY], lookup_rows=profile.count())
        scored = fraud.score_fraud(enriched, model, threshold=settings.fraud_prediction_threshold)
        return isolation_forest.score_anomaly(scored, nodes, details)

    return score


def run_scoring(
    transactions: DataFrame,
    settings: Settings = Settings(),
    processor: BatchProcessor | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Source -> window features -> (per micro-batch) history features, scores, graph signals, alerts, audit tables."""
    processor = processor or BatchProcessor(settings)
    processor.prepare = batch_scorer(transactions.sparkSession, settings)
    return start_stream(window_enrich_stream(transactions, settings), processor, settings, available_now)
