"""Table schemas written as text, without needing a session."""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "long": T.LongType()}


def table_schema(columns: str) -> T.StructType:
    """Schema of "name kind, name kind, ..."."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])
