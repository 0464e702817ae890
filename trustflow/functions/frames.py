"""Binary frame expressions: one zero byte, a big-endian uint32 schema id, then the datum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 5


def magic_hex(value: str = "value") -> Column:
    return F.hex(F.substring(value, 1, 1))


def schema_id_hex(value: str = "value") -> Column:
    return F.hex(F.substring(value, 2, 4))


def big_endian_uint32(value: str = "value") -> Column:
    return F.conv(schema_id_hex(value), 16, 10).cast("bigint")


def header_schema_id(value: str = "value") -> Column:
    """Schema id, NULL when the frame is too short or does not start with zero."""
    framed = (F.length(value) >= HEADER_BYTES) & (magic_hex(value) == "00")
    return F.when(framed, big_endian_uint32(value))


def body(value: str = "value") -> Column:
    return F.expr(f"substring({value}, {HEADER_BYTES + 1}, length({value}) - {HEADER_BYTES})")


def raw_record_id() -> Column:
    return F.concat_ws(
        ":", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")
    )
