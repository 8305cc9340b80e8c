import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from paywatch.operators.features import window_enrich
from paywatch.operators.history import historical_profile
from paywatch.settings import Settings
from paywatch.sources import audit
from paywatch.sources.transactions import message_files, parse_json_payload, publish_valid, run_available
from paywatch.streaming.enrich import history_enrich_stream, window_enrich_stream
from paywatch.streaming.scoring import BatchProcessor, start_alert_ingest, start_stream

SCHEMA = "transaction_id string, user_id string, account_id string, merchant_id string, amount double, timestamp string"


def message(number, minute, user="u1", hour=0):
    body = {
        "transaction_id": str(number), "user_id": user, "account_id": None, "merchant_id": f"m{number % 3}",
        "amount": float(number), "timestamp": f"2024-01-01T{hour:02d}:{minute:02d}:00", "extra": number,
    }
    return json.dumps({"key": user, "value": json.dumps(body), "timestamp": "2024-01-01T00:00:00Z"})


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(lines))


def collect(spark, stream, checkpoint):
    seen = []
    run_available(stream, str(checkpoint), lambda batch, _: seen.extend(batch.collect())).awaitTermination()
    return seen


def test_stream_equals_batch_after_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a", [message(i, i % 50, user=f"u{i % 4}" if i % 5 else " ") for i in range(60)])
    write(source, "b", [message(100, 0, hour=3)])
    stream = window_enrich_stream(parse_json_payload(message_files(spark, str(source))))
    rows = collect(spark, stream, tmp_path / "cp")
    batch = parse_json_payload(spark.read.schema("key string, value string, timestamp timestamp").json(str(source)))
    columns = ["transaction_id", "window_start", "transaction_count_per_user", "total_amount_per_user", "transaction_count_per_merchant"]
    expected = window_enrich(batch).where("window_end <= '2024-01-01 02:30:00'").select(*columns).collect()
    as_set = lambda found: {tuple(r[c] for c in columns) for r in found}
    assert len(rows) == len(expected) == 120
    assert as_set(rows) == as_set(expected)
    assert rows[0]["transaction_payload"]["extra"] is not None


def test_late_rows_are_dropped(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "1", [message(1, 0, hour=2)])
    stream = window_enrich_stream(parse_json_payload(message_files(spark, str(source))))
    collect(spark, stream, tmp_path / "cp")
    write(source, "2", [message(2, 0, hour=0), message(3, 50, hour=1), message(4, 0, hour=6)])
    rows = collect(spark, window_enrich_stream(parse_json_payload(message_files(spark, str(source)))), tmp_path / "cp")
    assert {r["transaction_id"] for r in rows} == {"1", "3"}


def test_published_rows_come_back(spark, rows, tmp_path):
    publish_valid(rows(SCHEMA, ("1", None, "a", "m", 2.5, "2024-01-01")), path=str(tmp_path / "topic"))
    back = spark.read.schema("key string, value string, timestamp timestamp").json(str(tmp_path / "topic"))
    found = parse_json_payload(back).first()
    assert (found["kafka_key"], found["account_id"], found["amount"], found["user_id"]) == ("a", "a", 2.5, None)


def test_scoring_stream_end_to_end(spark, rows, tmp_path):
    source = tmp_path / "in"
    write(source, "a", [message(i, i % 50, user=f"u{i % 4}") for i in range(1, 40)])
    write(source, "b", [message(1, 0, hour=3), message(200, 0, hour=3)])
    settings = Settings(
        scored_path=str(tmp_path / "scored"), alerts_path=str(tmp_path / "alerts"), edges_path=str(tmp_path / "edges"),
        nodes_path=str(tmp_path / "nodes"), signals_path=str(tmp_path / "signals"), checkpoint_location=str(tmp_path / "cp"),
    )
    history = parse_json_payload(spark.read.schema("key string, value string, timestamp timestamp").json(str(source)))
    enriched = history_enrich_stream(
        window_enrich_stream(parse_json_payload(message_files(spark, str(source))), settings), historical_profile(history)
    )
    scored = enriched.withColumns(
        {
            "fraud_probability": F.when(F.col("amount") > 30, 0.95).otherwise(0.1),
            "anomaly_score": F.lit(0.0),
            "fraud_prediction": (F.col("amount") > 30).cast("int"),
            "is_anomaly": F.lit(0),
        }
    )
    processor = BatchProcessor(
        settings, refresh_every=1, messages_path=str(tmp_path / "out"), clock=lambda: datetime(2024, 1, 1, tzinfo=timezone.utc)
    )
    start_stream(scored, processor, settings, available_now=True).awaitTermination()

    table = audit.read_table(spark, settings.scored_path, audit.SCORED_SCHEMA)
    assert table.count() == 39 and table.select("transaction_id").distinct().count() == 39
    alerts = audit.read_table(spark, settings.alerts_path, audit.ALERT_SCHEMA)
    assert {int(r["transaction_id"]) for r in alerts.collect()} == set(range(31, 40))
    assert alerts.where("alert_severity <> 'Medium' OR community_id IS NULL OR pagerank_score <= 0").isEmpty()
    assert sum(s["records_processed"] for s in processor.summaries) == 78
    last = processor.summaries[-1]
    assert sum(s["new_edges"] for s in processor.summaries) == last["total_edges"] == 39 and last["total_nodes"] == 7
    assert {r[0] for r in last["leaders"]} == {"pagerank", "triangles", "propagated_risk", "communities", "components"}
    sent = spark.read.json(str(tmp_path / "out"))
    assert sent.count() == 18  # one per window: messages are not deduplicated

    # the same batch once more, as after a failure
    batch = table.withColumns({"is_anomaly": F.lit(0)}).persist()
    batch.count()
    processor(batch.drop("batch_id", "processed_at", "alert_triggered", "alert_reason", "alert_severity", "alert_timestamp",
                         "pagerank_score", "community_id", "triangle_count", "component_id", "component_size",
                         "propagated_risk_score"), 77)
    assert audit.read_table(spark, settings.scored_path, audit.SCORED_SCHEMA).count() == 39
    assert audit.read_table(spark, settings.edges_path, processor_schema()).count() == 39


def processor_schema():
    from paywatch.streaming.scoring import EDGE_SCHEMA

    return EDGE_SCHEMA


def test_alert_ingest_stream(spark, tmp_path):
    text = json.dumps({"alert_triggered": True, "transaction_id": "7", "amount": "2.5"})
    write(tmp_path / "topic", "1", [json.dumps({"key": "7", "value": text})] * 2 + [json.dumps({"key": "8", "value": "{}"})])
    settings = Settings(alerts_path=str(tmp_path / "alerts"))
    messages = message_files(spark, str(tmp_path / "topic"))
    start_alert_ingest(messages, str(tmp_path / "cp"), settings, available_now=True).awaitTermination()
    found = audit.read_table(spark, settings.alerts_path, audit.ALERT_SCHEMA).collect()
    assert [(r["transaction_id"], r["amount"], r["batch_id"]) for r in found] == [("7", 2.5, None)]


def test_kafka_source_names_the_missing_connector(spark):
    from paywatch.sources.transactions import kafka_source

    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_source(spark)


def test_signals_survive_a_write_that_is_cut_off(spark, rows, tmp_path):
    from paywatch.settings import Settings
    from paywatch.streaming.scoring import EDGE_SCHEMA, NODE_SCHEMA, latest_signals, refresh_signals

    settings = Settings(**{f"{n}_path": str(tmp_path / n) for n in ("signals", "edges", "nodes")})
    assert latest_signals(spark, settings) is None
    edges = spark.createDataFrame([("customer:a", "merchant:b", "1", "1", 1.0, "2024-01-01T00:00:00", 0.5, 0.1)], EDGE_SCHEMA)
    nodes = spark.createDataFrame([("customer:a", "customer", "a"), ("merchant:b", "merchant", "b")], NODE_SCHEMA)
    edges.write.parquet(f"{settings.edges_path}/writer=scoring/write_id=0")
    nodes.write.parquet(f"{settings.nodes_path}/writer=scoring/write_id=0")
    first = sorted(map(tuple, refresh_signals(spark, settings).collect()))
    (tmp_path / "signals" / "version=000000000001").mkdir()  # begun, and never ended
    assert sorted(map(tuple, latest_signals(spark, settings).collect())) == first and len(first) == 2
    refresh_signals(spark, settings)
    assert sorted(map(tuple, latest_signals(spark, settings).collect())) == first


def test_trained_models_score_a_stream(spark, rows, tmp_path):
    from paywatch.streaming.compose import latest_profile, refresh_profile, run_scoring, train_models

    settings = Settings(
        checkpoint_location=str(tmp_path / "cp"),
        **{f"{n}_path": str(tmp_path / n) for n in ("scored", "alerts", "edges", "nodes", "signals", "profile", "fraud_model", "anomaly_model")},
    )
    past = rows(
        "transaction_id string, user_id string, account_id string, merchant_id string, amount double, timestamp string, label string",
        *[(f"p{i}", f"u{i % 4}", None, "m", 900.0 if i % 10 == 0 else 5.0 + i % 7, f"2023-12-{1 + i % 28:02d}T10:00:00", "fraud" if i % 10 == 0 else "legit")
          for i in range(200)],
    )
    train_models(past, settings, trees=3, depth=2)
    refresh_profile(past.drop("label"), settings)
    source = tmp_path / "in"
    write(source, "a", [message(i, i % 50, user=f"u{i % 4}") for i in range(1, 20)])
    write(source, "b", [message(100, 0, hour=3)])
    processor = BatchProcessor(settings, publish=False)
    stream = parse_json_payload(message_files(spark, str(source)))
    run_scoring(stream, settings, processor, available_now=True).awaitTermination()
    table = audit.read_table(spark, settings.scored_path, audit.SCORED_SCHEMA)
    assert table.count() == 19
    assert table.where("fraud_probability IS NULL OR fraud_probability NOT BETWEEN 0 AND 1 OR anomaly_score IS NULL").isEmpty()

    # the scorer of a running stream sees a renewed profile; the files of the former one stay
    batch = window_enrich(parse_json_payload(spark.read.schema("key string, value string, timestamp timestamp").json(str(source))), settings)
    former = latest_profile(spark, settings)
    total = lambda: processor.prepare(batch).agg(F.sum("historical_total_amount")).first()[0]
    before = total()
    refresh_profile(past.drop("label").withColumn("amount", F.col("amount") * 2), settings)
    assert total() == pytest.approx(2 * before) and former.count() == 4


SCORED = (
    "transaction_id string, user_id string, account_id string, merchant_id string, amount double, timestamp string, "
    "fraud_probability double, anomaly_score double, fraud_prediction int, is_anomaly int"
)


def graph_batches(rows):
    """Three batches: islands, then links between them and a repeat, then more of both."""
    def row(i, user, merchant):
        return (str(i), user, None, merchant, float(i % 7), f"2024-01-01T00:{i % 60:02d}:00", (i % 10) / 10, 0.5 * (i % 3), 0, 0)

    first = [row(i, f"u{i % 12}", f"m{i % 12 // 3}") for i in range(36)]
    second = [row(40 + i, f"u{3 * i}", f"m{i + 1}") for i in range(2)] + [row(0, "u0", "m9"), row(50, "new", "m3"), row(51, "zed", "alone")]
    third = [row(60 + i, f"u{i % 12}", f"m{(i + 5) % 7}") for i in range(8)] + [row(99, "zed", "m0")]
    return [rows(SCORED, *b) for b in (first, second, third)]


def test_grown_signals_equal_those_computed_anew(spark, rows, tmp_path, monkeypatch):
    from paywatch.operators.communities import modularity
    from paywatch.streaming import signals
    from paywatch.streaming.scoring import EDGE_SCHEMA

    settings = Settings(**{f"{n}_path": str(tmp_path / n) for n in ("scored", "alerts", "edges", "nodes", "signals")})
    processor, anew = BatchProcessor(settings, publish=False), []
    for number, batch in enumerate(graph_batches(rows)):
        processor(batch, number)  # the signals it uses do not know its nodes yet
        newest, last = signals.latest_signals(spark, settings), processor.summaries[-1]
        assert (0 if newest is None else newest.count()) == last["total_nodes"] - last["new_nodes"]
        with monkeypatch.context() as watched:
            whole = signals.connected_components
            watched.setattr(signals, "connected_components", lambda *a: anew.append(number) or whole(*a))
            signals.refresh_signals(spark, settings)
    assert anew == [0]  # later versions go on from the one before
    grown = {r["node_id"]: r for r in signals.latest_signals(spark, settings).collect()}
    edges = audit.read_table(spark, settings.edges_path, EDGE_SCHEMA).persist()
    grown_quality = modularity(edges, signals.latest_signals(spark, settings).select("node_id", "community_id")).first()[0]
    full = {r["node_id"]: r for r in signals.refresh_signals(spark, settings, anew=True).collect()}
    full_quality = modularity(edges, signals.latest_signals(spark, settings).select("node_id", "community_id")).first()[0]
    assert set(grown) == set(full) and len(full) == 14 + 9
    for node, r in full.items():
        assert (grown[node]["component_id"], grown[node]["component_size"]) == (r["component_id"], r["component_size"])
        assert grown[node]["pagerank_score"] == pytest.approx(r["pagerank_score"], rel=1e-9)
        assert grown[node]["propagated_risk_score"] == pytest.approx(r["propagated_risk_score"], rel=1e-9)
    assert grown_quality >= 0.95 * full_quality
    assert edges.count() == processor.summaries[-1]["total_edges"] == sum(s["new_edges"] for s in processor.summaries)
    assert {r["ranking"] for r in signals.latest_leaders(spark, settings).collect()} >= {"pagerank", "components"}


def test_refresh_without_totals_reads_the_edges(spark, rows, tmp_path):
    from paywatch.session import delete_path
    from paywatch.streaming import signals

    settings = Settings(**{f"{n}_path": str(tmp_path / n) for n in ("scored", "alerts", "edges", "nodes", "signals")})
    processor = BatchProcessor(settings, publish=False)
    first, second, _ = graph_batches(rows)
    processor(first, 0)
    signals.refresh_signals(spark, settings)
    processor(second, 1)
    delete_path(spark, f"{settings.signals_path}/_deltas/writer=scoring/write_id=1")
    found = {r["node_id"]: r["component_id"] for r in signals.refresh_signals(spark, settings).collect()}
    assert found["merchant:alone"] == found["customer:zed"] == "customer:zed" and found["customer:new"] == found["merchant:m3"]


def test_pagerank_from_former_scores(rows):
    from paywatch.operators.pagerank import link_counts, pagerank_power

    links = [(f"n{i}", f"n{(i * 7 + k) % 30}") for i in range(30) for k in (1, 5)]
    pairs = link_counts(rows("src string, dst string", *links))
    fresh = {r[0]: r[1] for r in pagerank_power(pairs, tolerance=1e-10).collect()}
    start = pagerank_power(pairs.where("src != 'n3'"), tolerance=1e-4)
    assert {r[0]: r[1] for r in pagerank_power(pairs, tolerance=1e-10, start=start).collect()} == pytest.approx(fresh, rel=1e-6)


def test_totals_of_a_stream_equal_those_of_a_batch(spark, rows, tmp_path):
    import time

    from paywatch.operators.validation import validation_counts
    from paywatch.streaming.validation import ValidationTotals, start_validation

    schema = "transaction_id string, user_id string, amount string, timestamp string"
    source = str(tmp_path / "records")
    for part in range(3):
        data = [(str(i) if i % 5 else None, f"u{i}", "x" if i % 7 == 0 else str(i), "2024-01-01") for i in range(10 * part, 10 * part + 10)]
        rows(schema, *data).coalesce(1).write.mode("append").parquet(source)
    batch = validation_counts(spark.read.parquet(source)).first().asDict()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    seen = ValidationTotals()
    spark.streams.addListener(seen)
    try:
        start_validation(stream, str(tmp_path / "cp"), messages_path=str(tmp_path / "topic"), rejects_path=str(tmp_path / "rejects"), available_now=True).awaitTermination()
        for _ in range(50):  # reports come from a thread of their own
            if seen.totals() == batch:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(seen)
    assert seen.totals() == batch and 0 < batch["invalid_records"] < batch["valid_records"]
    assert spark.read.json(str(tmp_path / "topic")).count() == batch["valid_records"]
    assert spark.read.parquet(str(tmp_path / "rejects")).where("reject_reason IS NOT NULL").count() == batch["invalid_records"]


def test_aggregates_are_repeated_for_slices_with_rows_only(rows):
    """A key of one row is kept once in join state, not once per slice; no slice with rows is left out."""
    from paywatch.streaming import enrich

    made = rows("k string, n int", ("one", 1), *[("many", i) for i in range(200)], *[("two", i) for i in range(2)])
    sliced = made.withColumn("_slice", enrich._slice_of(made, 8))
    found = enrich._per_seen_slice(sliced.groupBy("k").agg(enrich._seen_slices()), 8)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, sliced.select("k", "_slice").distinct().collect()))
    assert found.where("k = 'one'").count() == 1 and found.where("k = 'many'").count() == 8


def test_stream_query_keeps_little_open_at_once(spark, monkeypatch):
    """Events come in the order of their time in many micro-batches, so a store never has all windows; same rows."""
    from paywatch.plans import queries as plans

    started, run = [], plans.run_available
    monkeypatch.setattr(plans, "run_available", lambda *args: started.append(run(*args)) or started[-1])
    folder = "/root/testdata/sf0.001"
    whole = plans.QUERIES["stream_window_enrich"](spark, folder)
    expected = sorted(map(str, whole.collect()))
    monkeypatch.setattr(plans, "ARRIVALS_PER_CORE", 40)
    parts = plans.QUERIES["stream_window_enrich"](spark, folder).select(whole.columns)
    assert sorted(map(str, parts.collect())) == expected and len(expected) > 1000
    together, apart = ([p["stateOperators"][2]["numRowsTotal"] for p in q.recentProgress] for q in started)
    assert max(apart) < max(together) / 3
    assert spark.conf.get("spark.sql.streaming.maxBatchesToRetainInMemory", None) in (None, "2")


def test_parts_are_read_in_the_order_of_their_names(spark, tmp_path):
    from paywatch.sources.transactions import in_order

    path = str(tmp_path / "t")
    spark.range(100).repartitionByRange(5, "id").write.parquet(path)
    assert in_order(spark, path)
    files = sorted(p for p in (tmp_path / "t").glob("part-*"))
    times = [p.stat().st_mtime for p in files]
    assert len(files) == 5 and times == sorted(set(times))
