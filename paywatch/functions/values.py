"""Parsing of numbers and points in time that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from paywatch.functions.identity import WHITESPACE, strip

# What counts as a number written as text.
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))$"

# Marks that take the place of parts of a date, in the order they are looked for.
DATE_PARTS = (
    (r"[AP]M$", "p"),
    (r"\b[A-Z][a-z]{3,}\b", "B"),
    (r"\b[A-Z][a-z]{2}\b", "b"),
    (r"\d{8}", "D"),
    (r"\d{6}", "S"),
    (r"\d{4}", "Y"),
    (r"\d{1,2}", "n"),
)

# Date spellings accepted besides ISO 8601, by the shape their parts leave. In a shape
# that begins with "d" the first number cannot be a month.
DATE_FORMATS = {
    "n/n/Y": "M/d/yyyy",
    "n/n/Y n:n": "M/d/yyyy H:mm",
    "n/n/Y n:n:n": "M/d/yyyy H:mm:ss",
    "n/n/Y n:n p": "M/d/yyyy h:mm a",
    "n/n/Y n:n:n p": "M/d/yyyy h:mm:ss a",
    "dn/n/Y": "d/M/yyyy",
    "dn/n/Y n:n": "d/M/yyyy H:mm",
    "dn/n/Y n:n:n": "d/M/yyyy H:mm:ss",
    "Y/n/n": "yyyy/M/d",
    "Y/n/n n:n:n": "yyyy/M/d H:mm:ss",
    "Y-n-n n:n p": "yyyy-M-d h:mm a",
    "Y-n-n n:n:n p": "yyyy-M-d h:mm:ss a",
    "D": "yyyyMMdd",
    "DTS": "yyyyMMdd'T'HHmmss",
    "b n, Y": "MMM d, yyyy",
    "b n Y": "MMM d yyyy",
    "b n, Y n:n:n": "MMM d, yyyy H:mm:ss",
    "b n Y n:np": "MMM d yyyy h:mma",
    "B n, Y": "MMMM d, yyyy",
    "B n Y": "MMMM d yyyy",
    "n b Y": "d MMM yyyy",
    "n B Y": "d MMMM yyyy",
    "n-b-Y": "d-MMM-yyyy",
}
DAY_FIRST = r"^(1[3-9]|2\d|3[01])/"

# Fixed value: names of the zero offset at the end of a time of day.
ZERO_ZONE = r"(\d{1,2}:\d{2}[^+\-Z]*?) ?(UTC|GMT|Z)$"

# Fixed value: zone offset at the end of a text that also holds a time of day.
OFFSET_PATTERN = r"\d{1,2}:\d{2}[^+\-Z]*(Z|[+-]\d{2}(?::?\d{2})?)$"

TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_time_like(name: str) -> bool:
    """Columns whose name speaks of a time or a date."""
    lowered = name.lower()
    return "time" in lowered or "date" in lowered


def to_number(column: Column, data_type: T.DataType) -> Column:
    """Double value, null where the text is not a number."""
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    text = strip(column.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def iso_format(moment: Column) -> Column:
    """ISO 8601 text; the fraction appears only when it is not zero."""
    return F.regexp_replace(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")


def _other_spelling(text: Column) -> Column:
    """Wall-clock time of a text in one of DATE_FORMATS."""
    shape = text
    for part, mark in DATE_PARTS:
        shape = F.regexp_replace(shape, part, mark)
    shape = F.concat(F.when(text.rlike(DAY_FIRST), F.lit("d")).otherwise(F.lit("")), shape)
    spelling = F.element_at(F.create_map(*[F.lit(x) for pair in DATE_FORMATS.items() for x in pair]), shape)
    return F.try_to_timestamp(text, spelling).cast("timestamp_ntz")


def _zoned(text: Column) -> Column:
    """Trimmed text with a named zero offset as Z."""
    return F.regexp_replace(F.btrim(text, F.lit(WHITESPACE)), ZERO_ZONE, "$1Z")


def local_time(text: Column) -> Column:
    """Wall-clock time of a text, its zone offset aside; null when no known format fits."""
    trimmed = _zoned(text)
    # as a function of one value, which keeps the generated code small: the text is read many times
    other = F.element_at(F.transform(F.array(trimmed), _other_spelling), 1)
    return F.coalesce(trimmed.try_cast("timestamp_ntz"), other)


def iso_text(column: Column, data_type: T.DataType) -> Column:
    """Any accepted spelling as ISO 8601 text, keeping a zone offset; null when it does not parse."""
    if isinstance(data_type, TEMPORAL):
        return iso_format(column.cast("timestamp_ntz"))
    if isinstance(data_type, T.NumericType):
        # plain numbers are nanoseconds since 1970
        micros = F.floor(column.cast("double") / 1000).cast("long")
        return iso_format(F.timestamp_micros(micros).cast("timestamp_ntz"))
    text = column.cast("string")
    offset = F.regexp_extract(_zoned(text), OFFSET_PATTERN, 1)
    offset = F.when(offset == "Z", "+00:00").otherwise(offset)
    return F.concat(iso_format(local_time(text)), offset)


def event_time(column: str = "timestamp") -> Column:
    """Event time in the session zone; null when the text does not parse."""
    return F.col(column).try_cast("timestamp")


def clip01(value: Column) -> Column:
    """Into [0, 1]; null becomes 0."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def known(value: Column) -> Column:
    """Null for both null and NaN."""
    return F.when(~F.isnan(value), value)
