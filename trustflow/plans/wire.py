"""Frame bytes for the derived delivery view, built with native binary expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustflow.contract import Contract

OTHER_SCHEMA_ID, UNKNOWN_SCHEMA_ID, CONTRACT_SCHEMA_ID = 2, 404, 1


def small_varint(number: Column) -> Column:
    """Zig-zag varint of a number from 0 to 63 as one character; any other is an error."""
    told = F.raise_error(F.concat(F.lit("No one-byte varint: "), number.cast("string"))).cast("string")
    return F.when(number.isNull() | number.between(0, 63), F.chr(number * 2)).otherwise(told)


def micros_varint(ts: Column) -> Column:
    """Zig-zag varint of a timestamp between 1979 and 3111: always eight characters."""
    z = F.unix_micros(ts) * 2
    parts = [F.chr(F.shiftright(z, 7 * i) % 128 + 128) for i in range(7)]
    return F.concat(*parts, F.chr(F.shiftright(z, 49)))


def text(value: Column) -> Column:
    return F.concat(small_varint(F.length(value)), value)


def datum(contract: Contract) -> Column:
    """One character per byte, turned into bytes at the end. Texts are ASCII, at most 63 long."""
    parts = []
    for f in contract.fields:
        value = F.col(f.name)
        if f.kind == "enum":
            index = F.array_position(F.array(*[F.lit(n) for n in contract.event_names]), value)
            # A name outside the enum gets the first index past its end.
            past = F.lit(len(contract.event_names)).cast("bigint")
            body = small_varint(F.coalesce(F.nullif(index, F.lit(0)) - 1, past))
        elif f.kind == "timestamp":
            body = micros_varint(value)
        elif f.kind == "int":
            body = small_varint(value.cast("bigint"))
        else:
            body = text(value)
        if f.nullable:
            # The missing branch is byte 0; a present value follows branch byte 2.
            body = F.coalesce(F.concat(F.chr(F.lit(2)), body), F.chr(F.lit(0)))
        parts.append(body)
    return F.encode(F.concat(*parts), "ISO-8859-1")


def header(schema_id: int) -> Column:
    return F.unhex(F.lit(f"00{schema_id:08x}"))


def wire_value(kind: str = "wire_kind", body: str = "_body") -> Column:
    """Frame around the datum in ``body``, damaged as the kind says."""
    k, data = F.col(kind), F.col(body)
    head = (
        F.when(k == "bad_magic", F.unhex(F.lit("0100000001")))
        .when(k == "unknown_schema", header(UNKNOWN_SCHEMA_ID))
        .when(k == "other_schema", header(OTHER_SCHEMA_ID))
        .otherwise(header(CONTRACT_SCHEMA_ID))
    )
    kept = F.when(k == "truncated", F.substring(data, 1, 25)).otherwise(data)
    tail = F.when(k == "trailing", F.encode(F.lit("extra"), "UTF-8")).otherwise(F.unhex(F.lit("")))
    return (
        F.when(k == "tombstone", F.lit(None).cast("binary"))
        .when(k == "short", F.unhex(F.lit("000000")))
        .otherwise(F.concat(head, kept, tail))
    )
