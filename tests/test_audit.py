import pytest

from paywatch.sources import audit

ROW = "transaction_id string, amount double, timestamp string, fraud_probability double, alert_triggered boolean, alert_severity string"


def stored(spark, path, schema=audit.SCORED_SCHEMA):
    return audit.read_table(spark, path, schema)


def test_first_write_wins_and_replay_adds_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "scored")
    first = rows(ROW, ("1", 1.0, "b", 0.5, True, "Low"), ("1", 2.0, "a", 0.6, False, None), (None, 3.0, "a", 0.1, False, None))
    second = rows(ROW, ("1", 9.0, "a", 0.5, True, "Low"), ("2", float("nan"), "a", 0.6, False, None), (None, 3.0, "a", 0.1, False, None))
    audit.upsert_scored(first, path, 1, "t1")
    audit.upsert_scored(second, path, 2, "t2")
    audit.upsert_scored(second, path, 2, "t3")
    found = {(r["transaction_id"], r["batch_id"]): r for r in stored(spark, path).collect()}
    assert len(found) == 4 and stored(spark, path).count() == 4
    assert found[("1", 1)]["amount"] == 2.0  # the earlier of the two rows in the batch
    assert found[("2", 2)]["amount"] is None and found[("2", 2)]["processed_at"] == "t3"
    assert stored(spark, path).schema == audit.SCORED_SCHEMA


def test_only_triggered_rows_become_alerts(spark, rows, tmp_path):
    path = str(tmp_path / "alerts")
    audit.upsert_alerts(rows(ROW, ("1", 1.0, "a", 0.5, True, "Low"), ("2", 1.0, "a", 0.5, None, None)), path, 1, "t1")
    found = stored(spark, path, audit.ALERT_SCHEMA).collect()
    assert [(r["transaction_id"], r["received_at"]) for r in found] == [("1", "t1")]


def test_topic_and_scoring_share_the_alert_table(spark, rows, tmp_path):
    path = str(tmp_path / "alerts")
    audit.upsert_alerts(rows(ROW, ("1", 1.0, "a", 0.5, True, "Low")), path, 1, "t1")
    text = '{"alert_triggered": true, "transaction_id": "%s", "alert_severity": "High"}'
    audit.ingest_alert_messages(rows("value string", (text % "1",), (text % "5",)), path, 1, "t2")
    found = {r["transaction_id"]: r for r in stored(spark, path, audit.ALERT_SCHEMA).collect()}
    assert set(found) == {"1", "5"}
    assert (found["5"]["batch_id"], found["5"]["alert_severity"], found["1"]["received_at"]) == (None, "High", "t1")


def test_empty_table(spark, tmp_path):
    assert stored(spark, str(tmp_path / "none")).isEmpty()


def test_reports_reject_bad_arguments(rows):
    from paywatch.operators import reports

    alerts = rows("transaction_id string, alert_severity string, received_at string", ("1", "High", "b"), ("2", "Low", "a"))
    with pytest.raises(ValueError, match="Unknown severity"):
        reports.alerts_page(alerts, severity="Critical")
    with pytest.raises(ValueError, match="must not be blank"):
        reports.alert_by_id(alerts, "  ")
    total, page = reports.alerts_page(alerts, limit=0, offset=-3)
    assert total.first()[0] == 2 and [r["transaction_id"] for r in page.collect()] == ["1"]
    assert reports.alert_by_id(alerts, "9").isEmpty()


def test_dashboard_defaults_and_filters(rows):
    from paywatch.operators import reports

    table = rows(
        "transaction_id string, user_id string, risk_level string, risk_score double, timestamp string",
        ("T1", "Ann", "Critical", 0.9, "2024-01-31T10:00:00"),
        ("T2", "bob", "high", 0.2, "2024-02-01T10:00:00"),
        ("T3", "anna", None, None, "bad"),
    )
    full = reports.dashboard_defaults(table)
    assert {r["transaction_id"]: r["alert_reason"] for r in full.collect()} == {
        "T1": "High anomaly score", "T2": "Normal activity", "T3": "Normal activity",
    }
    assert reports.kpis(full).first().asDict() == {
        "total_alerts": 3, "critical_alerts": 1, "mean_fraud_probability": 0.55, "mean_anomaly_score": 0.0,
        "high_risk_transactions": 2, "active_users": 3,
    }
    names = lambda **f: sorted(r["transaction_id"] for r in reports.dashboard_filter(full, **f).collect())
    assert names(severity="HIGH") == ["T2"]
    assert names(severity="All", user_id="^an") == ["T1", "T3"]
    assert names(start_date="2024-01-31 10:00:00", end_date="2024-02-01") == ["T1"]
    trend = [tuple(r) for r in reports.severity_trend(full).collect()]
    assert trend == [("Feb 01", 1, 0, 1, 0, 0), ("Jan 31", 1, 1, 0, 0, 0)]  # text order
    assert {r["name"]: r["value"] for r in reports.severity_distribution(full).collect()} == {
        "Critical": 1, "High": 0, "Medium": 0, "Low": 0,
    }


def test_pages_after_a_known_row_equal_pages_by_offset(rows):
    from paywatch.operators import reports

    data = [(f"t{i:02d}" if i % 6 else None, ("High", "Low")[i % 2], f"2024-01-{1 + i % 4:02d}" if i % 9 else None) for i in range(40)]
    alerts = rows("transaction_id string, alert_severity string, received_at string", *data)
    named = alerts.where("transaction_id IS NOT NULL")
    after, pages = None, []
    while True:
        total, page = reports.alerts_page(named, limit=7, after=after)
        found = [(r["received_at"], r["transaction_id"]) for r in page.collect()]
        if not found:
            break
        assert found == [(r["received_at"], r["transaction_id"]) for r in reports.alerts_page(named, limit=7, offset=len(pages))[1].collect()]
        pages += found
        after = found[-1]
    assert len(pages) == len(set(pages)) == named.count() == total.first()[0]
    _, rest = reports.alerts_page(alerts, limit=500, after=("2024-01-02", None))
    assert rest.where("received_at = '2024-01-02' AND transaction_id IS NULL OR received_at > '2024-01-02'").isEmpty()
