"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key preference order of the producers.
PARTITION_KEY_ORDER = (
    "booking_journey_id",
    "appointment_id",
    "customer_id",
    "anonymous_id",
    "session_id",
)


def blank(col: Column) -> Column:
    """NULL or empty text."""
    return F.coalesce(col, F.lit("")) == ""


def first_non_blank(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def partition_key(order=PARTITION_KEY_ORDER) -> Column:
    return first_non_blank(*[F.col(c) for c in order])


def hash_identifier(prefix: str, *parts: Column) -> Column:
    """prefix + '_' + the first 32 hex digits of SHA-256 over the parts joined by ':'."""
    joined = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 32))


def number_of(identifier: Column, prefix: str) -> Column:
    """The number behind the prefix; NULL for another prefix, other characters or a number too large."""
    rest = F.substring(identifier, len(prefix) + 1, F.length(identifier))
    return F.when(identifier.startswith(prefix) & rest.rlike(r"\A[0-9]+\z"), rest.try_cast("bigint"))


def numbered(prefix: str, number: Column, width: int) -> Column:
    """prefix + number, zero-padded to at least ``width`` digits; longer numbers stay whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def whole_match(col: Column, pattern: str) -> Column:
    r"""Full match; plain ``$`` would accept a trailing newline."""
    return col.rlike(rf"\A(?:{pattern})\z")
