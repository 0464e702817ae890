"""Business rules as native expressions: every rule yields its code or NULL.

All rules on a row accumulate. ``codes`` joins them into one text first, because most rows
have none and ``concat_ws`` skips NULLs inside generated code; only offending rows pay for
the array work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustflow.contract import Contract
from trustflow.functions.ids import blank, whole_match
from trustflow.functions.times import seconds

Getter = Callable[[str], Column]


def _missing(contract: Contract, get: Getter, name: str) -> Column:
    kind = next(f.kind for f in contract.fields if f.name == name)
    return blank(get(name)) if kind in ("string", "enum") else get(name).isNull()


def required(contract: Contract, get: Getter) -> list[Column]:
    return [
        F.when(_missing(contract, get, f), F.lit(f"FIELD_REQUIRED:{f}")) for f in contract.required
    ]


def identity(contract: Contract, get: Getter) -> list[Column]:
    nobody = F.lit(True)
    for f in contract.identity:
        nobody = nobody & _missing(contract, get, f)
    return [F.when(nobody, F.lit("IDENTITY_REQUIRED"))]


def required_by_event(contract: Contract, get: Getter) -> list[Column]:
    out = []
    for f in contract.names:
        events = [n for n, needs in contract.required_by_event.items() if f in needs]
        if events:
            applies = get(contract.name_field).isin(events)
            out.append(
                F.when(applies & _missing(contract, get, f), F.lit(f"FIELD_REQUIRED:{f}"))
            )
    return out


def domains(contract: Contract, get: Getter) -> list[Column]:
    return [
        F.when(get(f).isNotNull() & ~get(f).isin(list(values)), F.lit(f"VALUE_NOT_ALLOWED:{f}"))
        for f, values in contract.allowed.items()
    ]


def pair_compatibility(contract: Contract, get: Getter) -> list[Column]:
    device, platform = get(contract.device_field), get(contract.platform_field)
    mismatch = F.lit(False)
    for name, platforms in contract.platforms_by_device.items():
        if platforms:
            fits = F.coalesce(platform.isin(list(platforms)), F.lit(False))
            mismatch = mismatch | (device.eqNullSafe(F.lit(name)) & ~fits)
    return [F.when(mismatch, F.lit("DEVICE_PLATFORM_MISMATCH"))]


def identifier_formats(contract: Contract, get: Getter) -> list[Column]:
    return [
        F.when(
            ~blank(get(f)) & ~whole_match(get(f), pattern),
            F.lit(f"IDENTIFIER_FORMAT_INVALID:{f}"),
        )
        for f, pattern in contract.patterns.items()
    ]


def version(contract: Contract, get: Getter) -> list[Column]:
    supported = get(contract.version_field).eqNullSafe(F.lit(contract.schema_version))
    return [F.when(~supported, F.lit("SCHEMA_VERSION_UNSUPPORTED"))]


def future_time(contract: Contract, get: Getter) -> list[Column]:
    limit = get(contract.received_at) + seconds(contract.max_skew_seconds)
    return [F.when(get(contract.event_time) > limit, F.lit("EVENT_TIME_TOO_FAR_IN_FUTURE"))]


def scheduled_before_booking(contract: Contract, get: Getter) -> list[Column]:
    booking = get(contract.name_field) == contract.booking_event
    early = get(contract.scheduled_field) < get(contract.event_time)
    return [F.when(booking & early, F.lit("SCHEDULED_START_BEFORE_BOOKING"))]


ALL_RULES = (
    required,
    identity,
    required_by_event,
    domains,
    pair_compatibility,
    identifier_formats,
    version,
    future_time,
    scheduled_before_booking,
)


def codes_text(contract: Contract, get: Getter, rules=ALL_RULES) -> Column:
    return F.concat_ws(",", *[code for rule in rules for code in rule(contract, get)])


def codes_array(text: Column) -> Column:
    """Sorted distinct codes; an empty array for empty text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.array_sort(F.array_distinct(F.split(text, ",")))
    )


def codes(contract: Contract, get: Getter = F.col, rules=ALL_RULES) -> Column:
    return codes_array(codes_text(contract, get, rules))
