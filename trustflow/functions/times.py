"""UTC parsing, formatting and bucketing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_OFFSET = r"(?:Z|[+-]00(?::?00(?::?00(?:\.0+)?)?)?)"
DATE_TIME = (
    r"(?:\d{4}-\d{2}-\d{2}|\d{8})."
    r"(?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{2}(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?)?)"
)
UTC_TEXT = r"\A" + DATE_TIME + ZERO_OFFSET + r"\z"
PARTS = (
    r"\A(\d{4})-?(\d{2})-?(\d{2}).(\d{2})(?::?(\d{2}))?(?::?(\d{2}))?(?:[.,](\d{1,6})\d*)?"
    + ZERO_OFFSET
    + r"\z"
)
MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_utc(text: Column) -> Column:
    """Timestamp of ISO-8601 calendar text with an explicit zero offset, NULL for anything else.

    A plain cast would also take naive text and shift other offsets. Basic and extended
    notation are read, and seconds or minutes may be left out; week dates are not read.
    """
    plain = F.regexp_replace(text, PARTS, "$1-$2-$3 $4:$5:$6.$7Z")
    # Groups that are absent leave a bare separator behind.
    plain = F.regexp_replace(F.regexp_replace(plain, ":(?=[:.])", ":00"), r"\.Z", "Z")
    return F.when(text.rlike(UTC_TEXT), plain.try_cast("timestamp"))


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, MICROS_Z)


def iso_offset(ts: Column) -> Column:
    """ISO text with +00:00, microseconds shown only when they are not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(micros)


def seconds(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def utc_date(ts: Column) -> Column:
    return F.to_date(ts)
