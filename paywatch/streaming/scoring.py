"""The scoring stream: enrich, score, attach graph signals, raise alerts, store and publish per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paywatch.functions.identity import customer_node, merchant_node
from paywatch.operators.alerts import alert_batch_counts, alert_messages, evaluate_alerts
from paywatch.operators.graph import graph_edges, graph_nodes
from paywatch.operators.risk import SIGNAL_COLUMNS, attach_graph_signals
from paywatch.settings import Settings
from paywatch.sources import audit
from paywatch.sources.runs import append_unseen, count_rows
from paywatch.sources.transactions import write_messages
from paywatch.streaming.signals import EDGE_SCHEMA, NODE_SCHEMA, SIGNAL_SCHEMA, latest_leaders, latest_signals, leave_totals, refresh_signals


def batch_summary(batch: DataFrame) -> DataFrame:
    """One row: records, anomalies and fraud predictions of a batch."""
    return batch.agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalies_detected"),
        F.coalesce(F.sum("fraud_prediction"), F.lit(0)).alias("fraud_predictions"),
    )


class BatchProcessor:
    """Handles the micro-batches of one scoring stream.

    The graph lives in tables, so a restart continues where the last batch ended, and a batch that is
    repeated replaces what it wrote before. Batches use the last complete version of the signals, which
    `refresh_signals` brings up to date as a job of its own, on its own schedule. With `refresh_every` above 0
    every so many batches do it themselves. `prepare` adds what a batch lacks before it is processed, such as
    the scores by the models and the profile of the moment. What a batch added to the graph, and who leads it,
    is part of its summary.
    """

    def __init__(
        self,
        settings: Settings = Settings(),
        refresh_every: int = 0,
        messages_path: str | None = None,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
        publish: bool = True,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        self.settings = settings
        self.refresh_every = max(0, refresh_every)
        self.messages_path = messages_path
        self.clock = clock
        self.publish = publish
        self.prepare = prepare
        self.summaries: list[dict] = []

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = (self.prepare(batch) if self.prepare else batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                self._process(batch, batch_id)
        finally:
            batch.unpersist()

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        settings, spark = self.settings, batch.sparkSession
        summary = batch_summary(batch).first().asDict()
        summary.update(self._update_graph(batch, batch_id))
        signals = self._signals(spark, batch_id)

        stamp = self.clock().isoformat()
        judged = evaluate_alerts(attach_graph_signals(batch, signals), stamp, settings)
        judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary.update(alert_batch_counts(judged).first().asDict())
            audit.upsert_scored(judged, settings.scored_path, batch_id, stamp)
            audit.upsert_alerts(judged, settings.alerts_path, batch_id, stamp)
            if self.publish:
                write_messages(alert_messages(judged), settings, settings.alerts_topic, self.messages_path)
        finally:
            judged.unpersist()
        leaders = latest_leaders(spark, settings)
        summary["leaders"] = [] if leaders is None else [tuple(r) for r in leaders.collect()]  # a few of each ranking
        self.summaries.append({"batch_id": batch_id, **summary})

    def _update_graph(self, batch: DataFrame, batch_id: int) -> dict:
        """Store the new edges and nodes of a batch; what they are, and the totals of the graph after it."""
        spark, settings, own = batch.sparkSession, self.settings, ("scoring", batch_id)
        src, dst = customer_node(batch.columns), merchant_node()
        skipped = batch.agg(F.count_if(src.isNull() | dst.isNull())).first()[0]
        new_nodes = append_unseen(graph_nodes(batch), settings.nodes_path, NODE_SCHEMA, "node_id", own)
        new_edges = append_unseen(graph_edges(batch), settings.edges_path, EDGE_SCHEMA, "transaction_id", own)
        leave_totals(spark, settings, own)
        return {
            "skipped_rows": skipped,
            "new_nodes": new_nodes,
            "new_edges": new_edges,
            "total_nodes": count_rows(spark, settings.nodes_path, NODE_SCHEMA),
            "total_edges": count_rows(spark, settings.edges_path, EDGE_SCHEMA),
        }

    def _signals(self, spark: SparkSession, batch_id: int) -> DataFrame:
        settings, newest = self.settings, latest_signals(spark, self.settings)
        if self.refresh_every and (batch_id % self.refresh_every == 0 or newest is None):
            newest = refresh_signals(spark, settings)
        if newest is None:
            return spark.createDataFrame([], SIGNAL_SCHEMA).select("node_id", *SIGNAL_COLUMNS)
        return newest.select("node_id", *SIGNAL_COLUMNS)


def start_stream(scored: DataFrame, processor, settings: Settings = Settings(), available_now: bool = False) -> StreamingQuery:
    """Start the scoring stream: append mode, checkpointed, one call of `processor` per micro-batch."""
    writer = (
        scored.writeStream.outputMode("append")
        .option("checkpointLocation", settings.checkpoint_location)
        .foreachBatch(processor)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_alert_ingest(
    messages: DataFrame,
    checkpoint: str,
    settings: Settings = Settings(),
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    available_now: bool = False,
) -> StreamingQuery:
    """Start the second stream: alert messages from the topic into the alert table, once per transaction."""

    def ingest(batch: DataFrame, batch_id: int) -> None:
        audit.ingest_alert_messages(batch, settings.alerts_path, batch_id, clock().isoformat())

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(ingest)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
