import itertools
import json

from pyspark.sql import functions as F

from paywatch.operators import alerts as a
from paywatch.settings import Settings
from paywatch.sources.audit import decode_alerts

SIGNALS = "transaction_id string, fraud_probability double, anomaly_score double, propagated_risk_score double"


def test_all_combinations_of_signals(rows):
    limits = (("fraud_probability", 0.8), ("anomaly_score", 0.7), ("propagated_risk_score", 0.75))
    cases = list(itertools.product((False, True), repeat=3))
    values = [
        (str(n), *[limit if hit else limit - 0.001 for hit, (_, limit) in zip(case, limits)]) for n, case in enumerate(cases)
    ]
    out = a.evaluate_alerts(rows(SIGNALS, *values), "now").collect()
    for row in out:
        case = cases[int(row["transaction_id"])]
        names = [name for hit, (name, _) in zip(case, limits) if hit]
        assert row["alert_triggered"] == bool(names)
        assert row["alert_reason"] == (", ".join(names) or None)
        expected = None if not names else "High" if len(names) >= 2 else "Low" if names == ["anomaly_score"] else "Medium"
        assert row["alert_severity"] == expected
        assert row["alert_timestamp"] == ("now" if names else None)


def test_unknown_signals_count_zero(rows):
    out = a.evaluate_alerts(rows(SIGNALS, ("1", None, float("nan"), None)), "now").first()
    assert (out["alert_triggered"], out["alert_severity"]) == (False, None)


def test_signal_count_for_high_is_at_least_one(rows):
    out = a.evaluate_alerts(rows(SIGNALS, ("1", 0.0, 0.9, 0.0)), "now", Settings(alert_high_signal_count=0)).first()
    assert out["alert_severity"] == "High"


def test_batch_counts(rows):
    values = [("1", 0.9, 0.0, 0.0), ("2", 0.9, 0.9, 0.0), ("3", 0.0, 0.9, 0.0), ("4", 0.0, 0.0, 0.0)]
    assert tuple(a.alert_batch_counts(a.evaluate_alerts(rows(SIGNALS, *values), "t")).first()) == (4, 3, 1, 1, 1)


def test_message_round_trip(rows):
    frame = rows(
        SIGNALS + ", user_id string, account_id string, merchant_id string, amount double, timestamp string",
        (" 7 ", 0.9, float("nan"), 0.8, "u", None, "m", 3.5, "2024-01-01"),
        (None, 0.9, 0.1, 0.1, "u", None, "m", 3.5, "2024-01-01"),
        ("8", 0.1, 0.1, 0.1, "u", None, "m", 3.5, "2024-01-01"),
    )
    sent = a.alert_messages(a.evaluate_alerts(frame, "now")).orderBy("key")
    messages = {r["key"]: json.loads(r["value"]) for r in sent.collect()}
    assert set(messages) == {"7", "unknown"}
    assert list(messages["7"])[:12] == list(a.MESSAGE_FIELDS)
    assert messages["7"]["anomaly_score"] is None and messages["7"]["alert_triggered"] is True
    decoded = decode_alerts(sent).where("transaction_id = '7'").first()
    assert (decoded["amount"], decoded["alert_severity"], decoded["anomaly_score"]) == (3.5, "High", None)


def test_decoding_flags(rows):
    flags = {"true": 1, '"true"': 1, '" YES "': 1, '"1"': 1, "1": 1, "0.5": 1, '[0]': 1, "false": 0, '"no"': 0, '"2"': 0,
             "0": 0, "0.0": 0, "null": 0, "[]": 0, "{}": 0, '""': 0}
    frame = rows("value string", *[(json.dumps({"transaction_id": f}) [:-1] + f', "alert_triggered": {f}}}',) for f in flags],
                 ('{"transaction_id": "missing"}',), ("not json",), ("[1]",), (None,))
    kept = {r["transaction_id"] for r in decode_alerts(frame).collect()}
    assert kept == {f.strip() for f, wanted in flags.items() if wanted}


def test_decoding_values(rows):
    text = '{"alert_triggered": true, "transaction_id": 12, "user_id": "  ", "amount": " 1.5 ", "anomaly_score": "x", "fraud_probability": "NaN"}'
    out = decode_alerts(rows("value string", (text,))).first()
    assert (out["transaction_id"], out["user_id"], out["amount"]) == ("12", None, 1.5)
    assert out["anomaly_score"] is None and out["fraud_probability"] is None


def test_severity_needs_no_reason_column(rows):
    assert a.alert_severity(rows(SIGNALS, ("1", 0.9, 0.0, 0.0))).select(F.max("alert_severity")).first()[0] == "Medium"
