"""Transaction sources and the topic of validated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from paywatch.functions.identity import partition_key
from paywatch.settings import Settings

# The core columns of a transaction message.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

MESSAGE_SCHEMA = "key string, value string, timestamp timestamp"


def scan_transactions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def kafka_source(spark: SparkSession, settings: Settings = Settings(), topic: str | None = None) -> DataFrame:
    """Stream of raw messages; needs the Spark Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.kafka_bootstrap_servers)
        .option("subscribe", topic or settings.transactions_topic)
        .option("startingOffsets", settings.starting_offsets)
        .load()
    )


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of raw messages from JSON files with key, value and timestamp: the topic's stand-in without a broker."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def parse_json_payload(messages: DataFrame) -> DataFrame:
    """Decode messages into the core columns, the whole payload as a map, and the message metadata."""
    value = F.col("value").cast("string")
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        value.alias("kafka_value"),
        F.from_json(value, TRANSACTION_SCHEMA).alias("transaction"),
        F.from_json(value, T.MapType(T.StringType(), T.StringType())).alias("transaction_payload"),
    ).select("kafka_key", "kafka_timestamp", "kafka_value", "transaction.*", "transaction_payload")


def publish_messages(valid: DataFrame) -> DataFrame:
    """Validated rows as messages: stable key, all columns as JSON, unknown as null."""
    key: Column = partition_key(valid.columns)
    return valid.select(
        key.alias("key"), F.to_json(F.struct(*valid.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def publish_valid(valid: DataFrame, settings: Settings = Settings(), path: str | None = None) -> None:
    """Write validated rows to the topic, or as JSON message files when a path is given."""
    write_messages(publish_messages(valid), settings, settings.transactions_topic, path)


def write_messages(messages: DataFrame, settings: Settings, topic: str, path: str | None = None) -> None:
    if path is not None:
        messages.write.mode("append").json(path)
        return
    messages.write.format("kafka").option("kafka.bootstrap.servers", settings.kafka_bootstrap_servers).option(
        "topic", topic
    ).save()


def run_available(df: DataFrame, checkpoint: str, handle) -> StreamingQuery:
    """Run a stream over what is there now, handing every micro-batch to `handle`."""
    return (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )


def in_order(spark: SparkSession, path: str) -> bool:
    """Have a file stream read the parts of a table one after the other; False where files cannot be dated.

    The stream takes the oldest files first, and parts that were written side by side are dated as it happens. A part
    may be in several files; parts and their files are numbered in their names, in that order.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    newest = max((files.getFileStatus(part).getModificationTime() for part in parts), default=0) // 1000 * 1000
    wanted = [newest - (len(parts) - at) * 1000 for at in range(len(parts))]
    try:
        for part, time in zip(parts, wanted):
            files.setTimes(part, time, -1)
    except Exception:  # some stores refuse
        return False
    return [files.getFileStatus(part).getModificationTime() for part in parts] == wanted
