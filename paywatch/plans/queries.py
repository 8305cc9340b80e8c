"""The named queries: every operator on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paywatch.functions.identity import merchant_key, partition_key, user_key
from paywatch.functions.values import event_time
from paywatch.models import fraud, isolation_forest, store
from paywatch.models.zscore import spending_spread, zscore_score
from paywatch.operators import alerts, features, graph, history, reports, risk, validation
from paywatch.operators.communities import communities as louvain
from paywatch.operators.components import component_sizes, connected_components
from paywatch.operators.pagerank import link_counts, pagerank, pagerank_power
from paywatch.operators.triangles import no_triangles, triangles
from paywatch.plans import views
from paywatch.plans.views import EVENT_SETTINGS, entity_edges, order_transactions, raw_transactions, session_edges, transactions
from paywatch.session import delete_at_end, even_files, read_in_small_parts, scratch_path
from paywatch.settings import FEATURE_COLUMNS, Settings
from paywatch.sources import audit
from paywatch.sources.transactions import in_order, parse_json_payload, publish_messages, run_available
from paywatch.streaming.enrich import window_enrich_stream
from paywatch.streaming.scoring import batch_summary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ALERT_STAMP = "2024-02-01T00:00:00+00:00"
_stored: dict[tuple[str, str, str], str] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        read_in_small_parts(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__.removeprefix("q_")] = run
    return run


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, written once per session to the shared folder and read by several queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = _stored.get(key)
    if path is None or not audit.path_exists(spark, path):
        path = scratch_path(spark, name)
        even_files(build()).parquet(path)
        _stored[key] = path
    return spark.read.parquet(path)


def ntz(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


def rounded(column: str, places: int = 6) -> Column:
    return F.round(F.col(column), places).alias(column)


def _audited(rows: DataFrame, *more: str) -> DataFrame:
    """The columns that graph, alerts and audit tables read; the others end here and are not written again."""
    return rows.select(*[c for c in audit.SCORED_SCHEMA.names if c in rows.columns], *more)


def scored(spark, sf_dir):
    return stored(spark, sf_dir, "scored", lambda: _audited(views.scored(spark, sf_dir), "window_start"))


def edges(spark, sf_dir):
    return stored(spark, sf_dir, "edges", lambda: graph.graph_edges(scored(spark, sf_dir)))


def nodes(spark, sf_dir):
    return stored(spark, sf_dir, "nodes", lambda: graph.graph_nodes(scored(spark, sf_dir)))


def components(spark, sf_dir):
    return stored(
        spark, sf_dir, "components", lambda: connected_components(edges(spark, sf_dir), nodes(spark, sf_dir))
    )


def base(spark, sf_dir):
    def build():
        found, members = edges(spark, sf_dir), components(spark, sf_dir)
        every = nodes(spark, sf_dir)
        return risk.base_risk(
            risk.node_exposure(found, every), pagerank(found, every), no_triangles(every), members, component_sizes(members)
        )

    return stored(spark, sf_dir, "base", build)


def signals(spark, sf_dir):
    """Signals per node; components stand in for communities, which SQL cannot compute (see `communities`)."""

    def build():
        own = base(spark, sf_dir)
        places = components(spark, sf_dir).select("node_id", F.col("component_id").alias("community_id"))
        return risk.graph_signals(own, places, risk.risk_propagation(own, edges(spark, sf_dir)))

    return stored(spark, sf_dir, "signals", build)


def judged(spark, sf_dir):
    """Scored rows with graph signals and alerts, once per window."""

    def build():
        attached = risk.attach_graph_signals(scored(spark, sf_dir), signals(spark, sf_dir))
        return _audited(alerts.evaluate_alerts(attached, ALERT_STAMP, EVENT_SETTINGS))

    return stored(spark, sf_dir, "judged", build)


def _stamp(batch: int) -> str:
    return f"2024-02-0{batch}T00:00:00+00:00"


def _day(number: int) -> Column:
    return F.lit(f"2024-01-{number:02d}")


def _batches(rows: DataFrame) -> list[DataFrame]:
    """The rows in three batches by event day, the first and the last open-ended; SQL cuts at the same days."""
    number = F.when(F.col("timestamp") < "2024-01-11", 1).when(F.col("timestamp") < "2024-01-21", 2).otherwise(3)
    return [rows.where(number == batch) for batch in (1, 2, 3)]


def scored_table(spark, sf_dir):
    """Audit table of three batches, by event day."""
    key = (spark.sparkContext.applicationId, sf_dir, "audit_scored")
    if key not in _stored or not audit.path_exists(spark, _stored[key]):
        path, rows = scratch_path(spark, "audit-scored"), judged(spark, sf_dir)
        for batch, part in enumerate(_batches(rows), start=1):
            audit.upsert_scored(part, path, batch, _stamp(batch))
        _stored[key] = path
    return audit.read_table(spark, _stored[key], audit.SCORED_SCHEMA)


def alert_table(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir, "audit_alerts")
    if key not in _stored or not audit.path_exists(spark, _stored[key]):
        path, rows = scratch_path(spark, "audit-alerts"), judged(spark, sf_dir)
        for batch, part in enumerate(_batches(rows), start=1):
            audit.upsert_alerts(part, path, batch, _stamp(batch))
        _stored[key] = path
    return audit.read_table(spark, _stored[key], audit.ALERT_SCHEMA)


def dashboard(spark, sf_dir):
    return reports.dashboard_defaults(scored_table(spark, sf_dir).drop("alert_severity", "alert_reason"))


# --- sources and sinks


@query
def scan_transactions(spark, sf_dir):
    return transactions(spark, sf_dir)


@query
def parse_json_payload_query(spark, sf_dir):
    source = transactions(spark, sf_dir)
    messages = publish_messages(source).withColumn("timestamp", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    parsed = parse_json_payload(messages)
    return parsed.select(
        "kafka_key",
        ntz("kafka_timestamp"),
        "transaction_id",
        "user_id",
        "account_id",
        "merchant_id",
        "amount",
        "timestamp",
        F.element_at("transaction_payload", "is_fraud").alias("payload_is_fraud"),
    )


QUERIES["parse_json_payload"] = QUERIES.pop("parse_json_payload_query")


@query
def training_sample(spark, sf_dir):
    rows = stored(spark, sf_dir, "enriched", lambda: views.enriched(spark, sf_dir))
    keyed = rows.withColumn("row_id", F.concat_ws("@", "transaction_id", "window_start"))
    return history.training_sample(keyed, "row_id", 2000)


@query
def alert_messages(spark, sf_dir):
    sent = alerts.alert_messages(judged(spark, sf_dir))
    schema = (
        "transaction_id string, user_id string, account_id string, merchant_id string, amount double, timestamp string, "
        "fraud_probability double, anomaly_score double, propagated_risk_score double, alert_reason string, "
        "alert_severity string, alert_timestamp string, alert_triggered boolean"
    )
    opened = sent.select("key", F.from_json("value", schema).alias("m")).select("key", "m.*")
    return opened.withColumn("propagated_risk_score", F.round("propagated_risk_score", 6))


def _topic_messages(spark, sf_dir) -> DataFrame:
    """Alert messages as other producers might write them: flags and numbers of every kind."""
    event, value = F.col("event_id"), F.col("value").cast("string")
    flag = (
        F.when(event % 7 == 0, "true").when(event % 7 == 1, '" Yes "').when(event % 7 == 2, "2")
        .when(event % 7 == 3, "false").when(event % 7 == 4, '"2"').when(event % 7 == 5, "0").otherwise("null")
    )
    amount = (
        F.when(event % 5 == 0, value).when(event % 5 == 1, F.concat(F.lit('" '), value, F.lit(' "')))
        .when(event % 5 == 2, '"abc"').when(event % 5 == 3, '"NaN"').otherwise("null")
    )
    text = F.concat(
        F.lit('{"transaction_id": " '), event.cast("string"), F.lit(' ", "user_id": '), F.col("user_id").cast("string"),
        F.lit(', "merchant_id": "  ", "amount": '), amount, F.lit(', "alert_reason": "fraud_probability", "alert_triggered": '),
        flag, F.lit("}"),
    )
    broken = F.when(event % 11 == 0, F.concat(F.lit("["), text)).otherwise(text)
    return views.table(spark, sf_dir, "events").select(broken.alias("value"))


@query
def decode_alerts(spark, sf_dir):
    return audit.decode_alerts(_topic_messages(spark, sf_dir))


@query
def upsert_scored(spark, sf_dir):
    """Two batches that overlap by ten days; both are run again, as after a failure, the first one after it was merged."""
    path, rows = scratch_path(spark, "upsert-scored"), judged(spark, sf_dir)
    early, late = rows.where(F.col("timestamp") < _day(21)), rows.where(F.col("timestamp") >= _day(11))
    audit.upsert_scored(early, path, 1, _stamp(1))
    audit.upsert_scored(late, path, 2, _stamp(2), fan_in=1)  # merges the first batch
    audit.upsert_scored(late, path, 2, _stamp(2))
    audit.upsert_scored(early, path, 1, _stamp(1))
    stored_rows = audit.read_table(spark, path, audit.SCORED_SCHEMA)
    return stored_rows.select("transaction_id", "amount", "fraud_probability", "fraud_prediction", "is_anomaly", "alert_triggered", "batch_id", "processed_at")


@query
def upsert_alerts(spark, sf_dir):
    path, rows = scratch_path(spark, "upsert-alerts"), judged(spark, sf_dir)
    early, late = rows.where(F.col("timestamp") < _day(21)), rows.where(F.col("timestamp") >= _day(11))
    audit.upsert_alerts(early, path, 1, _stamp(1))
    audit.upsert_alerts(late, path, 2, _stamp(2), fan_in=1)  # merges the first batch
    audit.upsert_alerts(late, path, 2, _stamp(2))
    audit.upsert_alerts(early, path, 1, _stamp(1))
    stored_rows = audit.read_table(spark, path, audit.ALERT_SCHEMA)
    return stored_rows.select("transaction_id", "amount", "fraud_probability", "alert_reason", "alert_severity", "batch_id", "received_at")


@query
def ingest_alert_messages(spark, sf_dir):
    path, messages = scratch_path(spark, "ingest"), _topic_messages(spark, sf_dir)
    audit.ingest_alert_messages(messages, path, 1, _stamp(1))
    audit.ingest_alert_messages(messages, path, 2, _stamp(2), fan_in=1)
    audit.ingest_alert_messages(messages, path, 3, _stamp(3))  # meets the merged first batch
    return audit.read_table(spark, path, audit.ALERT_SCHEMA).select(
        "transaction_id", "user_id", "merchant_id", "amount", "alert_reason", "community_id", "batch_id", "received_at"
    )


# --- validation and scalar rules


@query
def normalize_values(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount")).alias("discount"),
        F.date_format("l_shipdate", "M/d/yyyy").alias("ship_time_text"),
    )
    return validation.normalize_values(lines)


@query
def normalize_identifiers(spark, sf_dir):
    return validation.normalize_identifiers(raw_transactions(spark, sf_dir)).select(
        "transaction_id", "user_id", "account_id", "merchant_id"
    )


@query
def validate_amount(spark, sf_dir):
    return validation.validate_amount(raw_transactions(spark, sf_dir)).select("transaction_id", "amount", "amount_error")


@query
def normalize_timestamps(spark, sf_dir):
    return validation.normalize_timestamps(raw_transactions(spark, sf_dir)).select(
        "transaction_id", "timestamp", "settle_date", "time_error"
    )


@query
def validate_core_rules(spark, sf_dir):
    return validation.validate_core_rules(raw_transactions(spark, sf_dir)).select("transaction_id", "rule_error")


@query
def validation_split(spark, sf_dir):
    valid, rejected = validation.validation_split(raw_transactions(spark, sf_dir))
    return valid.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)


@query
def validation_counts(spark, sf_dir):
    return validation.validation_counts(raw_transactions(spark, sf_dir))


@query
def q_partition_key(spark, sf_dir):
    source = transactions(spark, sf_dir)
    return source.select("transaction_id", partition_key(source.columns).alias("partition_key"))


@query
def q_user_key(spark, sf_dir):
    source = transactions(spark, sf_dir)
    return source.select("transaction_id", user_key(source.columns).alias("user_key"))


@query
def q_merchant_key(spark, sf_dir):
    return transactions(spark, sf_dir).select("transaction_id", merchant_key().alias("merchant_key"))


@query
def q_event_time(spark, sf_dir):
    return transactions(spark, sf_dir).select("transaction_id", event_time().cast("timestamp_ntz").alias("event_time"))


@query
def calendar_features(spark, sf_dir):
    return features.base_features(transactions(spark, sf_dir)).select(
        "transaction_id", "transaction_hour", "transaction_day_of_week"
    )


@query
def high_amount_flag(spark, sf_dir):
    return features.base_features(order_transactions(spark, sf_dir)).select("transaction_id", "amount", "is_high_amount")


@query
def feature_matrix(spark, sf_dir):
    rows = views.enriched(spark, sf_dir).drop("historical_max_amount")
    return history.feature_matrix(rows).select(
        "transaction_id", ntz("window_start"), *[rounded(c) if "avg" not in c else rounded(c, 9) for c in FEATURE_COLUMNS]
    )


@query
def binary_target(spark, sf_dir):
    words = {"click": " Fraud ", "error": "legit", "purchase": "YES", "signup": "2", "view": "0"}
    event_type = F.col("event_type")
    label = F.lit("maybe")
    for name, word in words.items():
        label = F.when(event_type == name, word).otherwise(label)
    rows = views.table(spark, sf_dir, "events").select("event_id", label.alias("fraud_label"))
    return history.binary_target(rows).select("event_id", "fraud_label", "label")


# --- windows


@query
def sliding_assign(spark, sf_dir):
    rows = features.sliding_assign(features.base_features(transactions(spark, sf_dir)))
    return rows.select("transaction_id", ntz("window_start"), ntz("window_end"))


@query
def user_window_agg(spark, sf_dir):
    rows = features.user_window_agg(features.base_features(transactions(spark, sf_dir)))
    return rows.select(
        ntz("window_start"), ntz("window_end"), "user_agg_key", "transaction_count_per_user",
        rounded("total_amount_per_user"), rounded("avg_amount_per_user"),
    )


@query
def user_window_agg_uneven(spark, sf_dir):
    """Windows that are not a whole number of slides."""
    uneven = Settings(slide_duration="3 minutes")
    rows = features.user_window_agg(features.base_features(transactions(spark, sf_dir), uneven), uneven)
    return rows.select(
        ntz("window_start"), ntz("window_end"), "user_agg_key", "transaction_count_per_user", rounded("total_amount_per_user")
    )


#: Windows of many slides.
LONG_SETTINGS = Settings(window_duration="5 hours", slide_duration="5 minutes")


@query
def user_window_agg_long(spark, sf_dir):
    rows = features.user_window_agg(features.base_features(transactions(spark, sf_dir), LONG_SETTINGS), LONG_SETTINGS)
    return rows.select(
        ntz("window_start"), ntz("window_end"), "user_agg_key", "transaction_count_per_user", rounded("total_amount_per_user")
    )


@query
def window_enrich_long(spark, sf_dir):
    return features.window_enrich(transactions(spark, sf_dir), LONG_SETTINGS).select(
        "transaction_id", ntz("window_start"), ntz("window_end"), "transaction_count_per_user",
        rounded("total_amount_per_user"), "transaction_count_per_merchant",
    )


@query
def merchant_window_agg(spark, sf_dir):
    rows = features.merchant_window_agg(features.base_features(transactions(spark, sf_dir)))
    return rows.select(ntz("window_start"), ntz("window_end"), "merchant_agg_key", "transaction_count_per_merchant")


WINDOW_COLUMNS = [
    "transaction_id", "user_agg_key", "merchant_agg_key", "amount", "transaction_hour", "transaction_day_of_week", "is_high_amount",
]


def _window_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        *WINDOW_COLUMNS, ntz("window_start"), ntz("window_end"), "transaction_count_per_user",
        rounded("total_amount_per_user"), rounded("avg_amount_per_user"), "transaction_count_per_merchant",
    )


@query
def window_enrich(spark, sf_dir):
    return _window_output(features.window_enrich(transactions(spark, sf_dir), EVENT_SETTINGS))


#: Events that a micro-batch has per core; state stores keep what is open, and a batch of all events leaves all windows open.
ARRIVALS_PER_CORE = 64_000


def _arrivals(spark, sf_dir, folder: str) -> DataFrame:
    """The events as a stream that brings them in the order of their time, some files per micro-batch."""
    events, cores = views.table(spark, sf_dir, "events"), spark.sparkContext.defaultParallelism
    files = max(1, -(-events.count() // ARRIVALS_PER_CORE))
    source = spark.readStream.schema(events.schema)
    if files > cores:
        path = f"{folder}/arrivals"
        # equal times share a file, so no file begins before another one ends
        events.repartitionByRange(files, "ts").write.parquet(path)
        if in_order(spark, path):
            return source.option("maxFilesPerTrigger", cores).parquet(path)
    return source.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_window_enrich(spark, sf_dir):
    """The streaming form over the same events; windows the watermark has not passed are still open."""
    folder = scratch_path(spark, "stream")
    events = _arrivals(spark, sf_dir, folder)
    event = F.col("event_id")
    parsed = events.select(
        event.cast("string").alias("transaction_id"),
        F.when(event % 17 == 0, F.lit(None)).when(event % 19 == 0, "  ").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(event % 289 != 0, F.concat(F.lit("A"), F.col("user_id").cast("string"))).alias("account_id"),
        F.when(event % 23 != 0, F.concat(F.lit("M"), F.regexp_extract("props", "([0-9]+)", 1))).alias("merchant_id"),
        F.col("value").alias("amount"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/write_id={batch_id}")

    # state stores are kept per partition and cannot be merged later, so there is one per core
    # and a store holds the newest version of its state only, as nothing goes back to an older one
    wanted = {
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        # chosen before the batches are made, so that no state keeps a column that is not put out
        enriched = _window_output(window_enrich_stream(parsed, EVENT_SETTINGS))
        run_available(enriched, f"{folder}/checkpoint", keep).awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.parquet(f"{folder}/out").drop("write_id")


@query
def velocity(spark, sf_dir):
    return features.velocity(transactions(spark, sf_dir)).select(
        ntz("window_start"), ntz("window_end"), "user_agg_key", "velocity"
    )


@query
def q_batch_summary(spark, sf_dir):
    return batch_summary(views.scored(spark, sf_dir))


# --- history


@query
def historical_profile(spark, sf_dir):
    return history.historical_profile(transactions(spark, sf_dir)).select(
        history.HISTORY_KEY, "historical_transaction_count", rounded("historical_avg_amount", 9),
        rounded("historical_total_amount"), "historical_max_amount",
    )


@query
def historical_enrich(spark, sf_dir):
    source = transactions(spark, sf_dir)
    rows = history.historical_enrich(source, history.historical_profile(source))
    return rows.select(
        "transaction_id", history.HISTORY_KEY, "historical_transaction_count", rounded("historical_avg_amount", 9),
        rounded("historical_total_amount"), "historical_max_amount",
    )


TRAINING_OUTPUT = [
    "transaction_id", "amount", "transaction_hour", "transaction_day_of_week", "is_high_amount",
    "transaction_count_per_user", "historical_max_amount", "transaction_count_per_merchant", "historical_transaction_count",
]


@query
def training_features(spark, sf_dir):
    rows = history.training_features(order_transactions(spark, sf_dir))
    return rows.select(*TRAINING_OUTPUT, rounded("total_amount_per_user", 2), rounded("avg_amount_per_user", 4))


# --- models


@query
def class_balance(spark, sf_dir):
    labelled = history.binary_target(transactions(spark, sf_dir))
    return history.class_balance(labelled).withColumn("scale_pos_weight", F.round("scale_pos_weight", 6))


def fraud_model_path(spark, sf_dir) -> str:
    """Folder of the full-size model, which is fitted once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "fraud_model")
    if key not in _stored or not audit.path_exists(spark, _stored[key]):
        path = scratch_path(spark, "fraud-model")
        rows = stored(spark, sf_dir, "enriched", lambda: views.enriched(spark, sf_dir))
        store.save_fraud_model(spark, *fraud.train_fraud_model(rows), path)
        delete_at_end(spark, path)
        _stored[key] = path
    return _stored[key]


@query
def score_fraud(spark, sf_dir):
    rows = stored(spark, sf_dir, "enriched", lambda: views.enriched(spark, sf_dir))
    model, _ = store.load_fraud_model(spark, fraud_model_path(spark, sf_dir))
    return fraud.score_fraud(rows, model).select(
        "transaction_id", ntz("window_start"), "fraud_probability", "fraud_prediction"
    )


@query
def score_anomaly(spark, sf_dir):
    rows = stored(spark, sf_dir, "enriched", lambda: views.enriched(spark, sf_dir))
    keyed = rows.withColumn("row_id", F.concat_ws("@", "transaction_id", "window_start"))
    trees, details = isolation_forest.train_isolation_forest(keyed, "row_id")
    return isolation_forest.score_anomaly(rows, trees, details).select(
        "transaction_id", ntz("window_start"), "anomaly_score", "is_anomaly"
    )


@query
def anomaly_share(spark, sf_dir):
    """What is certain about the forest: it scores every row and flags close to the wanted share of them."""
    flagged = F.avg("is_anomaly").between(0.015, 0.025)
    return score_anomaly(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"), flagged.alias("share_kept"))


@query
def q_zscore_score(spark, sf_dir):
    source = transactions(spark, sf_dir)
    rows = zscore_score(
        source.withColumn("model_score", F.least(F.col("amount") / 500.0, F.lit(1.0))), spending_spread(source), "model_score"
    )
    return rows.select("transaction_id", rounded("z_score"), rounded("final_score"))


# --- graph


@query
def graph_edges(spark, sf_dir):
    source = order_transactions(spark, sf_dir).withColumns(
        {"fraud_probability": F.lit(0.5), "anomaly_score": F.lit(None).cast("double")}
    )
    return graph.graph_edges(source)


@query
def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(transactions(spark, sf_dir))


@query
def graph_update_stats(spark, sf_dir):
    """Two overlapping batches: the first into an empty graph, the second into what the first left."""
    source = scored(spark, sf_dir)
    first, second = source.where(F.col("timestamp") < _day(21)), source.where(F.col("timestamp") >= _day(11))
    kept_edges, kept_nodes = graph.graph_edges(first), graph.graph_nodes(first)
    stats = [
        graph.graph_update_stats(first, kept_nodes.where("false"), kept_edges.where("false")),
        graph.graph_update_stats(second, kept_nodes, kept_edges),
    ]
    return stats[0].withColumn("batch_id", F.lit(1)).unionByName(stats[1].withColumn("batch_id", F.lit(2)))


@query
def q_pagerank(spark, sf_dir):
    return pagerank(edges(spark, sf_dir), nodes(spark, sf_dir)).select("node_id", rounded("pagerank_score", 9))


@query
def q_pagerank_power(spark, sf_dir):
    ranked = pagerank_power(link_counts(edges(spark, sf_dir)), nodes(spark, sf_dir), tolerance=1e-12)
    return ranked.select("node_id", rounded("pagerank_score", 8))


@query
def weighted_projection(spark, sf_dir):
    return graph.weighted_projection(edges(spark, sf_dir)).select("node_a", "node_b", rounded("weight"))


@query
def communities(spark, sf_dir):
    return louvain(edges(spark, sf_dir))


@query
def communities_stars(spark, sf_dir):
    """Every order linked to its lines: disjoint stars, whose communities are certain."""
    line = F.concat_ws("-", F.concat(F.lit("L"), F.col("l_orderkey").cast("string")), F.col("l_linenumber").cast("string"))
    order = F.concat(F.lit("O"), F.col("l_orderkey").cast("string"))
    return louvain(views.table(spark, sf_dir, "lineitem").select(order.alias("src"), line.alias("dst"), F.lit(1.0).alias("amount")))


@query
def q_triangles(spark, sf_dir):
    return triangles(entity_edges(spark, sf_dir))


@query
def q_connected_components(spark, sf_dir):
    return connected_components(session_edges(spark, sf_dir))


@query
def q_component_sizes(spark, sf_dir):
    return component_sizes(connected_components(session_edges(spark, sf_dir)))


@query
def edge_risk(spark, sf_dir):
    return edges(spark, sf_dir).select("edge_key", F.round(risk.edge_risk(), 9).alias("edge_risk"))


@query
def node_exposure(spark, sf_dir):
    return risk.node_exposure(edges(spark, sf_dir), nodes(spark, sf_dir)).select("node_id", rounded("exposure"))


@query
def base_risk(spark, sf_dir):
    return base(spark, sf_dir).select("node_id", rounded("base_risk"))


@query
def risk_propagation(spark, sf_dir):
    return risk.risk_propagation(base(spark, sf_dir), edges(spark, sf_dir)).select(
        "node_id", rounded("propagated_risk_score")
    )


@query
def attach_graph_signals(spark, sf_dir):
    rows = risk.attach_graph_signals(scored(spark, sf_dir), signals(spark, sf_dir))
    return rows.select(
        "transaction_id", ntz("window_start"), rounded("pagerank_score", 9), "community_id", "triangle_count",
        "component_id", "component_size", rounded("propagated_risk_score"),
    )


@query
def top_nodes(spark, sf_dir):
    return risk.top_nodes(signals(spark, sf_dir)).withColumn("value", F.round("value", 6))


# --- alerts


@query
def alert_rules(spark, sf_dir):
    attached = risk.attach_graph_signals(scored(spark, sf_dir), signals(spark, sf_dir))
    return alerts.alert_rules(attached, EVENT_SETTINGS).select(
        "transaction_id", ntz("window_start"), "alert_triggered", "alert_reason"
    )


@query
def alert_severity(spark, sf_dir):
    attached = risk.attach_graph_signals(scored(spark, sf_dir), signals(spark, sf_dir))
    return alerts.alert_severity(attached, EVENT_SETTINGS).select("transaction_id", ntz("window_start"), "alert_severity")


@query
def alert_batch_counts(spark, sf_dir):
    return alerts.alert_batch_counts(judged(spark, sf_dir))


# --- investigation


@query
def alerts_page(spark, sf_dir):
    total, page = reports.alerts_page(alert_table(spark, sf_dir), limit=25, offset=10, severity=" medium ")
    return page.select("transaction_id", "amount", "alert_reason", "received_at", total.scalar().alias("total"))


@query
def alerts_next_page(spark, sf_dir):
    """The page of `alerts_page` again, reached from the last row of the ten before it."""
    table = alert_table(spark, sf_dir)
    _, before = reports.alerts_page(table, limit=10, severity="Medium")
    rows = before.select("received_at", "transaction_id").collect()
    after = tuple(rows[-1]) if len(rows) == 10 else None
    total, page = reports.alerts_page(table, limit=25, severity="Medium", after=after)
    return page.select("transaction_id", "amount", "alert_reason", "received_at", total.scalar().alias("total"))


@query
def alert_by_id(spark, sf_dir):
    table = alert_table(spark, sf_dir)
    first = table.agg(F.min("transaction_id")).first()[0]
    return reports.alert_by_id(table, f" {first} ").select("transaction_id", "amount", "fraud_probability", "alert_severity")


@query
def alert_metrics(spark, sf_dir):
    return reports.alert_metrics(alert_table(spark, sf_dir)).withColumns(
        {c: F.round(c, 6) for c in ("avg_fraud_probability", "avg_anomaly_score", "avg_propagated_risk_score")}
    )


@query
def top_merchants(spark, sf_dir):
    return reports.top_merchants(alert_table(spark, sf_dir))


@query
def scored_count(spark, sf_dir):
    return reports.scored_count(scored_table(spark, sf_dir))


@query
def dashboard_defaults(spark, sf_dir):
    return dashboard(spark, sf_dir).select(
        "transaction_id", "alert_severity", "fraud_probability", "anomaly_score", rounded("propagated_risk"), "alert_reason"
    )


@query
def dashboard_filter(spark, sf_dir):
    rows = reports.dashboard_filter(
        dashboard(spark, sf_dir), severity="low", user_id="[13]", merchant_id="m4", start_date="2024-01-05", end_date="2024-01-25 12:00:00"
    )
    return rows.select("transaction_id", "user_id", "merchant_id", "alert_severity", "timestamp")


@query
def kpis(spark, sf_dir):
    return reports.kpis(dashboard(spark, sf_dir))


@query
def severity_trend(spark, sf_dir):
    return reports.severity_trend(dashboard(spark, sf_dir))


@query
def severity_distribution(spark, sf_dir):
    return reports.severity_distribution(scored_table(spark, sf_dir))


@query
def top_reasons(spark, sf_dir):
    return reports.top_reasons(alert_table(spark, sf_dir))


@query
def top_alerts(spark, sf_dir):
    return reports.top_alerts(dashboard(spark, sf_dir)).withColumn("propagated_risk", F.round("propagated_risk", 6))


@query
def cluster_risk(spark, sf_dir):
    return reports.cluster_risk(signals(spark, sf_dir)).withColumn("risk", F.round("risk", 6))


@query
def risk_trend(spark, sf_dir):
    return reports.risk_trend(scored_table(spark, sf_dir)).select(ntz("window_start"), rounded("risk"))


@query
def entity_risk_table(spark, sf_dir):
    return reports.entity_risk_table(nodes(spark, sf_dir), signals(spark, sf_dir)).withColumn("risk", F.round("risk", 6))


@query
def pipeline_latency(spark, sf_dir):
    """Stamps derived from the event: ingest after its props value, scoring and alerting after its id, in milliseconds."""

    def later(column: str, millis: Column) -> Column:
        return F.timestamp_micros(F.unix_micros(F.col(column).cast("timestamp")) + millis.cast("long") * 1000)

    rows = views.table(spark, sf_dir, "events").withColumn(
        "received", later("ts", F.regexp_extract("props", "([0-9]+)", 1))
    )
    rows = rows.withColumn("processed", later("received", F.col("event_id") % 37)).withColumn(
        "alerted", later("processed", F.col("event_id") % 53)
    )
    out = reports.pipeline_latency(rows, "ts", "received", "processed", "alerted")
    return out.select(ntz("window_start"), rounded("ingest_ms"), rounded("scoring_ms"), rounded("alerting_ms"))


@query
def kpi_delta_7d(spark, sf_dir):
    rows = reports.kpi_delta_7d(dashboard(spark, sf_dir))
    means = {c: F.round(c, 6) for c in ("fraud_probability_delta", "anomaly_score_delta")}
    return rows.withColumns({"day": F.col("day").cast("string"), **means})
