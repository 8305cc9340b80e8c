"""Views that read the test tables as payment transactions. See FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywatch.functions.values import known
from paywatch.operators.features import window_enrich
from paywatch.operators.history import historical_enrich, historical_profile
from paywatch.session import Scratch
from paywatch.settings import Settings

# amounts of the events table stay below the production threshold of 1,000
EVENT_SETTINGS = Settings(high_amount_threshold=100.0, alert_propagated_threshold=0.22)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def over_all_cores(rows: DataFrame) -> DataFrame:
    """Rows of a file dealt out where one part holds more than two cores' share; else they stay where they are.

    Parts are cut by bytes, but rows lie in whole row groups, so a file of many parts may have its rows in one.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))  # reads no column
    seen = parts.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return rows.repartition(cores) if (seen["most"] or 0) * cores > 2 * (seen["all"] or 0) else rows


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transaction; some ids are missing or blank so that the identity rules matter."""
    return as_transactions(table(spark, sf_dir, "events"))


def as_transactions(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    return events.select(
        event.cast("string").alias("transaction_id"),
        F.when(event % 17 == 0, F.lit(None)).when(event % 19 == 0, "  ").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(event % 289 != 0, F.concat(F.lit("A"), F.col("user_id").cast("string"))).alias("account_id"),
        F.when(event % 23 != 0, F.concat(F.lit("M"), F.regexp_extract("props", "([0-9]+)", 1))).alias("merchant_id"),
        F.col("value").alias("amount"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as it might arrive: padded ids, amounts that are text, timestamps in several spellings."""
    event, value = F.col("event_id"), F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        F.when(event % 101 == 0, "   ").otherwise(F.concat(F.lit(" "), event.cast("string"), F.lit("\t"))).alias("transaction_id"),
        F.when(event % 17 == 0, F.lit(None)).when(event % 19 == 0, " \n").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(event % 289 != 0, F.concat(F.lit("A"), F.col("user_id").cast("string"), F.lit(" "))).alias("account_id"),
        F.concat(F.lit("M"), F.regexp_extract("props", "([0-9]+)", 1)).alias("merchant_id"),
        F.when(event % 29 == 0, "abc").when(event % 31 == 0, F.concat(F.lit("-"), value)).when(event % 37 != 0, value).alias("amount"),
        F.when(event % 41 == 0, "not a date")
        .when(event % 43 == 0, F.date_format("ts", "M/d/yyyy"))
        .when(event % 47 == 0, "")
        .when(event % 53 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(event % 59 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(event % 61 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("timestamp"),
        F.when(event % 67 == 0, "soon").when(event % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).alias("settle_date"),
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions of the ordering customer with the supplier; transaction ids repeat."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.lit(None).cast("string").alias("account_id"),
        F.col("l_suppkey").cast("string").alias("merchant_id"),
        F.col("l_extendedprice").alias("amount"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )


def session_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer to merchant session (one merchant, ten minutes): all events, in many components."""
    slot = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 600_000_000)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("customer:"), F.col("user_id").cast("string")).alias("src"),
        F.concat(F.lit("merchant:M"), F.regexp_extract("props", "([0-9]+)", 1), F.lit("@"), slot.cast("string")).alias("dst"),
        F.col("value").alias("amount"),
    )


def entity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, supplier and part of every line item, pairwise linked: a graph full of triangles."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    named = lines.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("c"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("s"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("p"),
    )
    ends = [("c", "s"), ("c", "p"), ("s", "p")]
    return named.select(
        F.explode(F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst")) for a, b in ends])).alias("e")
    ).select("e.src", "e.dst")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window and history features of every transaction, once per window.

    Windows, profile and rows each read the transactions, which are therefore made and written once.
    """
    source = Scratch(spark, "transactions").write(as_transactions(over_all_cores(table(spark, sf_dir, "events"))), "rows")
    return historical_enrich(window_enrich(source, EVENT_SETTINGS), historical_profile(source), source)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows with fixed formulas in place of the trained models, so that results can be checked in SQL."""
    rows = enriched(spark, sf_dir)
    odds = -3.0 + 0.02 * F.col("amount") + 0.5 * (F.coalesce("transaction_count_per_user", F.lit(0)) - 1) + 0.3 * F.col("is_high_amount")
    above = F.coalesce(F.col("amount") / F.nullif(known(F.col("historical_avg_amount")), F.lit(0.0)) - 1.0, F.lit(0.0))
    return rows.withColumns(
        {
            "fraud_probability": F.round(1.0 / (1.0 + F.exp(-odds)), 6),
            "anomaly_score": F.round(above / (1.0 + F.abs(above)), 6),
        }
    ).withColumns(
        {
            "fraud_prediction": (F.col("fraud_probability") >= 0.5).cast("int"),
            "is_anomaly": (F.col("anomaly_score") >= 0.7).cast("int"),
        }
    )
