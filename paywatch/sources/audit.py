"""Audit tables: scored transactions, alerts and the stored graph, written once per transaction id.

A batch that is run again after a failure replaces its own run, so nothing is stored twice, not even rows
without an id; ids that any other run holds are left out. How runs are laid out, looked up and merged is in
`runs`. One writer at a time per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paywatch.functions.identity import strip
from paywatch.functions.values import known
from paywatch.operators.dedup import first_per_id
from paywatch.sources.runs import FAN_IN, append_unseen, read_runs
from paywatch.sources.schema import table_schema

# Columns of the two tables, in order.
SCORED_SCHEMA = table_schema(
    "transaction_id string, user_id string, account_id string, merchant_id string, amount double, "
    "timestamp string, fraud_probability double, fraud_prediction int, anomaly_score double, is_anomaly int, "
    "propagated_risk_score double, pagerank_score double, community_id string, triangle_count long, "
    "component_id string, component_size long, alert_triggered int, alert_reason string, alert_severity string, "
    "alert_timestamp string, batch_id long, processed_at string"
)
ALERT_SCHEMA = table_schema(
    "transaction_id string, user_id string, account_id string, merchant_id string, amount double, "
    "timestamp string, fraud_probability double, anomaly_score double, propagated_risk_score double, "
    "pagerank_score double, community_id string, triangle_count long, component_id string, component_size long, "
    "alert_reason string, alert_severity string, alert_timestamp string, batch_id long, received_at string"
)
PAYLOAD_TEXTS = ("transaction_id", "user_id", "account_id", "merchant_id", "timestamp", "alert_reason", "alert_severity")
PAYLOAD_NUMBERS = ("amount", "fraud_probability", "anomaly_score", "propagated_risk_score")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored rows; an empty table while nothing was written."""
    return read_runs(spark, path, schema)


def append_once(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    writer: str,
    write_id: int,
    key: str,
    order: Sequence[str],
    fan_in: int = FAN_IN,
) -> int:
    """Store the first row of every id that no other batch stored; rows without an id are all stored. Returns how many."""
    return append_unseen(first_per_id(batch, key, order), path, schema, key, (writer, write_id), fan_in)


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table's columns in order; absent ones null, NaN as null."""
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            value = F.lit(None)
        elif isinstance(df.schema[field.name].dataType, (T.DoubleType, T.FloatType)):
            value = known(F.col(field.name))
        elif field.name in ("alert_triggered", "fraud_prediction", "is_anomaly"):
            value = F.col(field.name).cast("boolean")
        else:
            value = F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(columns)


def upsert_scored(
    batch: DataFrame, path: str, batch_id: int, processed_at: str, writer: str = "scoring", fan_in: int = FAN_IN
) -> int:
    """Store all rows of a scored batch that are not stored yet; returns how many."""
    stamped = batch.withColumns({"batch_id": F.lit(batch_id), "processed_at": F.lit(processed_at)})
    return append_once(
        aligned(stamped, SCORED_SCHEMA), path, SCORED_SCHEMA, writer, batch_id, "transaction_id", ["timestamp"], fan_in
    )


def upsert_alerts(
    batch: DataFrame, path: str, batch_id: int, received_at: str, writer: str = "scoring", fan_in: int = FAN_IN
) -> int:
    """Store the rows of a scored batch that raised an alert; returns how many."""
    raised = batch.where(F.coalesce(F.col("alert_triggered").cast("boolean"), F.lit(False)))
    stamped = raised.withColumns({"batch_id": F.lit(batch_id), "received_at": F.lit(received_at)})
    return append_once(
        aligned(stamped, ALERT_SCHEMA), path, ALERT_SCHEMA, writer, batch_id, "transaction_id", ["timestamp"], fan_in
    )


def decode_alerts(messages: DataFrame) -> DataFrame:
    """Alert messages that were triggered, as typed columns; anything that is not a JSON object is dropped."""
    body = F.try_parse_json(F.col("value").cast("string"))
    decoded = messages.withColumn("_body", body).withColumn(
        "_flag", F.to_json(F.try_variant_get("_body", "$.alert_triggered", "variant"))
    )
    word = F.lower(F.btrim(F.col("_flag"), F.lit('"')))
    quoted = F.col("_flag").startswith('"')
    true_text = F.trim(word).isin("true", "1", "yes")
    # what counts as false when it is not a text: false, null, zero and empty containers
    true_value = ~F.col("_flag").isin("false", "null", "[]", "{}") & (
        F.coalesce(F.col("_flag").try_cast("double"), F.lit(1.0)) != 0.0
    )
    triggered = F.coalesce(F.when(quoted, true_text).otherwise(true_value), F.lit(False))
    columns = {}
    for name in PAYLOAD_TEXTS:
        columns[name] = strip(F.try_variant_get("_body", f"$.{name}", "string"))
    for name in PAYLOAD_NUMBERS:
        columns[name] = known(F.trim(F.try_variant_get("_body", f"$.{name}", "string")).try_cast("double"))
    names = [f.name for f in ALERT_SCHEMA.fields if f.name in columns]
    return decoded.where(triggered).select(*[columns[n].alias(n) for n in names])


def ingest_alert_messages(
    messages: DataFrame, path: str, write_id: int, received_at: str, writer: str = "topic", fan_in: int = FAN_IN
) -> int:
    """Store triggered alerts from the topic; graph signals, batch and stamp of the alert stay unknown. Returns how many.

    The messages are decoded once: what is looked up and written comes from the kept result.
    """
    stamped = decode_alerts(messages).withColumn("received_at", F.lit(received_at))
    return append_once(
        aligned(stamped, ALERT_SCHEMA), path, ALERT_SCHEMA, writer, write_id, "transaction_id", ["timestamp"], fan_in
    )
