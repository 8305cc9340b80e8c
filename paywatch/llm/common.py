"""Helpers shared by the text operators.

Bulk work in Python runs in `mapInArrow`: Spark deals out and shuffles the rows, and a task sees one
Arrow batch at a time. Texts are handled as UTF-8 bytes throughout.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# Workers receive the functions of this package with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules["paywatch.llm"])

WHITE_SPACE = b" \t\n\x0b\x0c\r"

OUT_BYTES = 8 << 20

#: Bytes of a batch that goes to a Python task; texts are long, and a batch exists several times at once.
IN_BYTES = 8 << 20
#: Level of the compression of texts on the move: a quick one.
PACK_LEVEL = 3

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """`df.mapInArrow`; the session's batches are made smaller first if they are larger than IN_BYTES."""
    settings = df.sparkSession.conf
    now = settings.get(BATCH_SETTING, None)
    if now is None or not now.rstrip("b").isdigit() or int(now.rstrip("b")) > IN_BYTES:
        settings.set(BATCH_SETTING, str(IN_BYTES))
    return df.mapInArrow(task, schema)


def share(spark: SparkSession, value: Any) -> Broadcast:
    """A value of bounded size for all tasks, which get it back with `shared`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(value: Broadcast) -> Any:
    return cloudpickle.loads(value.value)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every value; null is empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def packed(rows: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """The keys and the compressed text of every row, for a shuffle that moves whole texts; `unpacked` reads them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=PACK_LEVEL).compress
        for batch in batches:
            bodies = pa.array([press(body) for body in texts_of(batch.column(text))], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], bodies], names=[*keys, text])

    kept = rows.select(*keys, text)
    kinds = dict(kept.dtypes)
    return map_arrow(kept, task, ", ".join([*[f"{k} {kinds[k]}" for k in keys], f"{text} binary"]))


def unpacked(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of `packed` texts, one at a time."""
    press = zstandard.ZstdDecompressor().decompress
    return (press(body.as_buffer()) for body in column)


class Rows:
    """Gathers output rows and cuts them into batches of bounded bytes."""

    def __init__(self, schema: pa.Schema, limit: int = OUT_BYTES) -> None:
        self.schema, self.limit, self.rows, self.size = schema, limit, [], 0

    def add(self, size: int, *row: object) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def parts_for(total: int | None, per_part: int, least: int = 1) -> int:
    """Partitions that a measured total needs."""
    return max(least, -(-int(total or 0) // per_part))


def text_bytes(df: DataFrame, text: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0

