"""Payment-fraud analytics on Spark: validation, features, scoring, graph signals, alerts, reports."""
