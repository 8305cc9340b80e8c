"""Validation of a stream: valid rows to the topic, rejected ones set aside, totals counted on the way.

The totals are observed while a micro-batch passes, without a pass of their own, and a listener of the
session adds up what the batches report.
"""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from paywatch.operators.validation import REASON, count_columns, validate
from paywatch.settings import Settings
from paywatch.sources.transactions import publish_valid

METRIC = "validation"


class ValidationTotals(StreamingQueryListener):
    """Records read, valid and invalid over all micro-batches of the streams that were started with it.

    A batch that is repeated after a failure reports again; only its last report counts.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._batches: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(METRIC)
        if found is not None:
            with self._lock:
                self._batches[str(event.progress.id), event.progress.batchId] = found.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self) -> dict[str, int]:
        names = ("total_records_read", "valid_records", "invalid_records")
        with self._lock:
            return {name: sum(batch[name] for batch in self._batches.values()) for name in names}


def validate_stream(df: DataFrame) -> DataFrame:
    """Validated rows of a stream, whose counts every micro-batch reports; rows come out with their reason."""
    return validate(df).observe(METRIC, *count_columns())


def start_validation(
    records: DataFrame,
    checkpoint: str,
    settings: Settings = Settings(),
    messages_path: str | None = None,
    rejects_path: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the stream that publishes valid records and stores rejected ones, each micro-batch parsed once."""

    def split(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            publish_valid(batch.where(F.col(REASON).isNull()).drop(REASON), settings, messages_path)
            if rejects_path is not None:
                batch.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(f"{rejects_path}/write_id={batch_id}")
        finally:
            batch.unpersist()

    writer = validate_stream(records).writeStream.option("checkpointLocation", checkpoint).foreachBatch(split)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
