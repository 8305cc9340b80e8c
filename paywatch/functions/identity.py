"""Identity rules: who a transaction belongs to, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

ID_COLUMNS = ("transaction_id", "user_id", "account_id", "merchant_id")

# Characters removed from both ends of free-text identifiers.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    """Text without surrounding whitespace of any kind; blank becomes null."""
    bare = F.btrim(text.cast("string"), F.lit(WHITESPACE))
    return F.when(bare != "", bare)


def non_blank(column: str) -> Column:
    """Text without surrounding spaces; blank becomes null."""
    bare = F.trim(F.col(column).cast("string"))
    return F.when(bare != "", bare)


def user_key(columns: Iterable[str]) -> Column:
    """user_id, or account_id where the user is missing or blank."""
    present = [c for c in ("user_id", "account_id") if c in set(columns)]
    if not present:
        raise ValueError("A user is known by user_id or account_id; the table has neither.")
    return F.coalesce(*[non_blank(c) for c in present])


def merchant_key() -> Column:
    return non_blank("merchant_id")


def customer_node(columns: Iterable[str]) -> Column:
    present = [c for c in ("user_id", "account_id") if c in set(columns)]
    return F.concat(F.lit("customer:"), F.coalesce(*[strip(F.col(c)) for c in present]))


def merchant_node() -> Column:
    return F.concat(F.lit("merchant:"), strip(F.col("merchant_id")))


def partition_key(columns: Iterable[str]) -> Column:
    """Message key: first of user, account, transaction that is not empty (spaces count as a value)."""
    present = [c for c in ("user_id", "account_id", "transaction_id") if c in set(columns)]
    candidates = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in present]
    return F.coalesce(*candidates, F.lit("unknown-key"))
