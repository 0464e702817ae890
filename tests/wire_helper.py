"""A small Avro writer for test frames."""

import datetime as dt
import struct

from trustflow.contract import default_contract

CONTRACT = default_contract()
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def varint(n: int) -> bytes:
    z = (n << 1) ^ (n >> 63)
    out = bytearray()
    while z > 0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    out.append(z)
    return bytes(out)


def micros(text: str) -> int:
    moment = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return (moment - EPOCH) // dt.timedelta(microseconds=1)


def datum(event: dict) -> bytes:
    out = b""
    for f in CONTRACT.fields:
        value = event.get(f.name)
        if f.nullable:
            out += varint(0 if value is None else 1)
            if value is None:
                continue
        if f.kind == "enum":
            out += varint(value if isinstance(value, int) else CONTRACT.event_names.index(value))
        elif f.kind == "timestamp":
            out += varint(value if isinstance(value, int) else micros(value))
        elif f.kind == "int":
            out += varint(value)
        else:
            data = value if isinstance(value, bytes) else value.encode()
            out += varint(len(data)) + data
    return out


def frame(event: dict, schema_id: int = 1) -> bytes:
    return b"\x00" + struct.pack(">I", schema_id) + datum(event)


def booking(**changes) -> dict:
    event = {
        "event_id": "evt_" + "a" * 32,
        "event_name": "appointment_booked",
        "event_time": "2025-03-04T09:10:00.000000Z",
        "received_at": "2025-03-04T09:10:03.000000Z",
        "anonymous_id": "anon_" + "b" * 32,
        "customer_id": "cus_00000042",
        "session_id": "ses_" + "c" * 32,
        "booking_journey_id": "bkj_" + "d" * 32,
        "appointment_id": "apt_" + "e" * 32,
        "scheduled_start_time": "2025-03-06T12:00:00.000000Z",
        "provider_id": "prv_000007",
        "device_type": "mobile",
        "platform": "ios",
        "specialty": "pediatrics",
        "schema_version": 1,
    }
    event.update(changes)
    return event
