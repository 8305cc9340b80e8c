"""Validation of incoming records: every row leaves with normalised values and at most one reason to reject it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paywatch.functions.identity import ID_COLUMNS, strip
from paywatch.functions.values import TEMPORAL, iso_text, is_time_like, to_number

REASON = "reject_reason"


def _plain_value(field: T.StructField) -> Column:
    """NaN as null, decimals as doubles; everything else as it is."""
    value, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.DecimalType):
        return value.cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def normalize_values(df: DataFrame) -> DataFrame:
    """Null-likes to null, points in time to ISO text, decimals to doubles."""
    columns = []
    for field in df.schema.fields:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, TEMPORAL):
            value = iso_text(value, kind)
        elif isinstance(kind, T.StringType) and is_time_like(field.name):
            value = F.coalesce(iso_text(value, kind), value)
        else:
            value = _plain_value(field)
        columns.append(value.alias(field.name))
    return df.select(columns)


def normalize_identifiers(df: DataFrame) -> DataFrame:
    """Identifiers as text without surrounding whitespace; blank becomes null."""
    present = {c: strip(F.col(c)) for c in ID_COLUMNS if c in df.columns}
    return df.withColumns(present)


def amount_error(df: DataFrame) -> Column:
    """Reason the amount cannot be used; null for a missing amount, which is checked elsewhere."""
    raw = F.col("amount")
    number = to_number(raw, df.schema["amount"].dataType)
    return F.when(raw.isNotNull() & number.isNull(), F.lit("amount must be numeric")).when(
        number < 0, F.lit("amount must be greater than or equal to 0")
    )


def validate_amount(df: DataFrame) -> DataFrame:
    """Amount as double plus `amount_error`."""
    number = to_number(F.col("amount"), df.schema["amount"].dataType)
    return df.withColumns({"amount_error": amount_error(df), "amount": number})


def _with_iso(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add the ISO text of every time-like column as `_iso_<name>`, parsed once; and the names of those columns."""
    columns = [c for c in df.columns if is_time_like(c)]
    return df.withColumns({f"_iso_{c}": iso_text(F.col(c), df.schema[c].dataType) for c in columns}), columns


def _time_error(name: str) -> Column:
    return F.when(F.col(name).isNotNull() & F.col(f"_iso_{name}").isNull(), F.lit(f"{name} must be parseable"))


def _first_reason(reasons: list[Column]) -> Column:
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def normalize_timestamps(df: DataFrame) -> DataFrame:
    """ISO text in every column whose name speaks of a time or date, plus `time_error` for the first that does not parse."""
    parsed, columns = _with_iso(df)
    error = _first_reason([_time_error(c) for c in columns]).alias("time_error")
    kept = [F.col(f"_iso_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    return parsed.select(*kept, error)


def core_rule_error(df: DataFrame) -> Column:
    """First broken rule on id, amount and identity; a rule counts only when its column exists."""
    columns = set(df.columns)
    reasons = []
    if "transaction_id" in columns:
        reasons.append(
            F.when(strip(F.col("transaction_id")).isNull(), F.lit("transaction_id cannot be null or empty"))
        )
    if "amount" in columns:
        reasons.append(F.when(F.col("amount").isNull(), F.lit("amount is required")))
        reasons.append(amount_error(df))
    identity = [c for c in ("user_id", "account_id") if c in columns]
    if identity:
        owner = F.coalesce(*[strip(F.col(c)) for c in identity])
        reasons.append(F.when(owner.isNull(), F.lit("user_id or account_id is required")))
    return _first_reason(reasons)


def validate_core_rules(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_error", core_rule_error(df))


def validate(df: DataFrame) -> DataFrame:
    """Normalised records plus `reject_reason`; a text that does not parse stays as it came.

    Order of the checks: amount and timestamp as fields, then the other time-like columns, then the
    core rules.
    """
    parsed, times = _with_iso(df)
    clean = normalize_identifiers(parsed.select([_plain_value(f).alias(f.name) for f in parsed.schema.fields]))
    reasons = []
    if "amount" in df.columns:
        reasons.append(F.concat(F.lit("amount: Value error, "), amount_error(clean)))
    if "timestamp" in times:
        reasons.append(F.concat(F.lit("timestamp: Value error, "), _time_error("timestamp")))
    reasons.extend(_time_error(c) for c in times if c != "timestamp")
    reasons.append(core_rule_error(clean))

    def output(name: str) -> Column:
        if name in times:
            return F.coalesce(F.col(f"_iso_{name}"), F.col(name).cast("string")).alias(name)
        if name == "amount":
            return to_number(F.col(name), clean.schema[name].dataType).alias(name)
        return F.col(name)

    return clean.select(*[output(c) for c in df.columns], _first_reason(reasons).alias(REASON))


def validation_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reason.

    Both are filters over one plan; a caller that writes both should write `validate(df)` once, or
    persist it, so that the input is read once.
    """
    marked = validate(df)
    return marked.where(F.col(REASON).isNull()).drop(REASON), marked.where(F.col(REASON).isNotNull())


def stored_split(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """`validation_split` by way of a stored table: the input is read and parsed once, each part reads its own files."""
    validate(df).withColumn("_valid", F.col(REASON).isNull()).write.partitionBy("_valid").parquet(path)
    marked = df.sparkSession.read.schema(T.StructType([*validate(df).schema.fields, T.StructField("_valid", T.BooleanType())])).parquet(path)
    valid, rejected = (marked.where(F.col("_valid") == kept).drop("_valid") for kept in (True, False))
    return valid.drop(REASON), rejected


def count_columns() -> list[Column]:
    """Records read, valid and invalid among validated rows."""
    return [
        F.count(F.lit(1)).alias("total_records_read"),
        F.count_if(F.col(REASON).isNull()).alias("valid_records"),
        F.count_if(F.col(REASON).isNotNull()).alias("invalid_records"),
    ]


def validation_counts(df: DataFrame) -> DataFrame:
    """One row: records read, valid, invalid."""
    return validate(df).agg(*count_columns())
