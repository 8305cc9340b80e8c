from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from paywatch.operators import validation as v

SCHEMA = "transaction_id string, user_id string, account_id string, merchant_id string, amount string, timestamp string, birth_date string"
GOOD = ("t1", "u1", "a1", "m1", "12.5", "2024-01-05T10:00:00", "2000-01-01")


def changed(**fields):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return tuple(fields.get(n, g) for n, g in zip(names, GOOD))


def reason(rows, **fields):
    return v.validate(rows(SCHEMA, changed(**fields))).first()[v.REASON]


def test_valid_record_has_no_reason(rows):
    assert reason(rows) is None


def test_first_broken_rule_wins(rows):
    assert reason(rows, amount="abc", timestamp="nope", transaction_id=" ") == "amount: Value error, amount must be numeric"
    assert reason(rows, amount="-1") == "amount: Value error, amount must be greater than or equal to 0"
    assert reason(rows, timestamp="nope", birth_date="soon") == "timestamp: Value error, timestamp must be parseable"
    assert reason(rows, birth_date="soon", transaction_id="") == "birth_date must be parseable"
    assert reason(rows, transaction_id=" \t", amount=None) == "transaction_id cannot be null or empty"
    assert reason(rows, amount=None) == "amount is required"
    assert reason(rows, user_id=" ", account_id=None) == "user_id or account_id is required"


def test_null_timestamp_is_allowed_and_blank_is_not(rows):
    assert reason(rows, timestamp=None) is None
    assert reason(rows, timestamp="") == "timestamp: Value error, timestamp must be parseable"


def test_rules_count_only_for_present_columns(rows):
    assert v.validate(rows("merchant_id string", ("m",))).first()[v.REASON] is None
    assert v.validate(rows("account_id string", (" ",))).first()[v.REASON] == "user_id or account_id is required"


def test_numbers_as_text(rows):
    texts = ["1e3", " 7 ", "+.5", "1.5d", "1_000", "0x10", "", "inf", "12,5"]
    found = v.validate_amount(rows("amount string", *[(t,) for t in texts])).collect()
    assert [r["amount"] for r in found] == [1000.0, 7.0, 0.5, None, None, None, None, float("inf"), None]
    assert [r["amount_error"] is None for r in found] == [True, True, True, False, False, False, False, True, False]


def test_nan_amount_is_missing(rows):
    frame = rows("transaction_id string, user_id string, amount double", ("t", "u", float("nan")))
    assert v.validate(frame).first()[v.REASON] == "amount is required"


def test_timestamp_spellings(rows):
    texts = {
        "2024-01-05": "2024-01-05T00:00:00",
        "2024-01-05 10:30": "2024-01-05T10:30:00",
        "1/5/2024": "2024-01-05T00:00:00",
        "20240105": "2024-01-05T00:00:00",
        "Jan 5, 2024": "2024-01-05T00:00:00",
        "2024-01-05T10:30:00.25": "2024-01-05T10:30:00.250000",
        "2024-01-05T10:30:00+02:00": "2024-01-05T10:30:00+02:00",
        "2024-01-05T10:30:00Z": "2024-01-05T10:30:00+00:00",
        "tomorrow": None,
    }
    found = v.normalize_timestamps(rows("event_time string", *[(t,) for t in texts])).collect()
    assert [r["event_time"] for r in found] == list(texts.values())
    assert found[-1]["time_error"] == "event_time must be parseable"
    assert all(r["time_error"] is None for r in found[:-1])


def test_normalize_values(rows, spark):
    frame = rows(
        "paid_at timestamp_ntz, price decimal(8,2), score double, update_time string",
        (datetime(2024, 1, 5, 1, 2, 3), Decimal("1.50"), float("nan"), "whenever"),
    )
    assert tuple(v.normalize_values(frame).first()) == ("2024-01-05T01:02:03", 1.5, None, "whenever")


def test_split_and_counts_cover_all_rows(rows):
    frame = rows(SCHEMA, GOOD, changed(amount="x"), changed(user_id=None, account_id=""))
    valid, rejected = v.validation_split(frame)
    assert (valid.count(), rejected.count()) == (1, 2)
    assert tuple(v.validation_counts(frame).first()) == (3, 1, 2)
    assert rejected.where(F.col(v.REASON).isNull()).isEmpty()


def test_usual_date_spellings(rows):
    from pyspark.sql import functions as F, types as T

    from paywatch.functions.values import iso_text

    spellings = {
        "January 5, 2024": "2024-01-05T00:00:00", "5-Jan-2024": "2024-01-05T00:00:00", "2024-01-05 3:04 PM": "2024-01-05T15:04:00",
        "20240105T030405": "2024-01-05T03:04:05", "Jan 5 2024 3:00PM": "2024-01-05T15:00:00", "13/01/2024": "2024-01-13T00:00:00",
        "2024-01-05 10:00:00 UTC": "2024-01-05T10:00:00+00:00", "\t1/13/2024\n": "2024-01-13T00:00:00", "5 March 2024": "2024-03-05T00:00:00",
        "2024-01-05T10:00:00+02:00": "2024-01-05T10:00:00+02:00", "junk": None, "32/01/2024": None,
    }
    frame = rows("t string", *[(s,) for s in spellings])
    found = {r["t"]: r["i"] for r in frame.select("t", iso_text(F.col("t"), T.StringType()).alias("i")).collect()}
    assert found == spellings


def test_stored_split_equals_the_split(rows, tmp_path):
    from paywatch.operators.validation import stored_split, validation_split

    data = rows(
        "transaction_id string, user_id string, amount string, timestamp string",
        ("1", "u", "2.5", "2024-01-01"), (None, "u", "1", "2024-01-01"), ("3", "u", "abc", "2024-01-01"), ("4", " ", "1", "bad"),
    )
    for stored, direct in zip(stored_split(data, str(tmp_path / "marked")), validation_split(data)):
        assert stored.schema == direct.schema and sorted(stored.collect(), key=str) == sorted(direct.collect(), key=str)
