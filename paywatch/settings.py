"""Thresholds, window sizes and table locations, passed explicitly to the functions that need them."""

from __future__ import annotations

from dataclasses import dataclass

# The names and order of the model features.
FEATURE_COLUMNS = (
    "amount",
    "transaction_hour",
    "transaction_day_of_week",
    "is_high_amount",
    "transaction_count_per_user",
    "total_amount_per_user",
    "avg_amount_per_user",
    "transaction_count_per_merchant",
    "historical_transaction_count",
    "historical_avg_amount",
    "historical_total_amount",
    "historical_max_amount",
)

# Label columns, in the order they are looked for.
TARGET_COLUMNS = ("is_fraud", "fraud_label", "fraud", "label", "target")


@dataclass(frozen=True)
class Settings:
    """One immutable bag of parameters; every field has the production default."""

    scored_path: str = "audit/scored_transactions"
    alerts_path: str = "audit/fraud_alerts"
    edges_path: str = "audit/graph_edges"
    nodes_path: str = "audit/graph_nodes"
    signals_path: str = "audit/graph_signals"
    profile_path: str = "audit/historical_profile"

    # Topics, window sizes and thresholds that results depend on.
    kafka_bootstrap_servers: str = "localhost:9092"
    transactions_topic: str = "transactions"
    alerts_topic: str = "fraud_alerts"
    starting_offsets: str = "latest"
    checkpoint_location: str = "audit/checkpoints/transactions"

    high_amount_threshold: float = 1000.0
    window_duration: str = "10 minutes"
    slide_duration: str = "5 minutes"
    watermark_delay: str = "30 minutes"

    fraud_model_path: str = "models/fraud"
    anomaly_model_path: str = "models/anomaly"
    fraud_prediction_threshold: float = 0.5
    anomaly_contamination: float = 0.02

    alert_fraud_threshold: float = 0.8
    alert_anomaly_threshold: float = 0.7
    alert_propagated_threshold: float = 0.75
    alert_high_signal_count: int = 2
