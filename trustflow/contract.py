"""The event contract as data: field list, value rules and identifier formats.

Operators read a ``Contract``; they hold no domain constants of their own.
``load_contract`` builds one from an Avro schema file and a JSON rule matrix.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

RULE_VERSION = "1.0.0"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # string | enum | timestamp | int
    nullable: bool = False
    has_default: bool = False


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    event_names: tuple[str, ...]
    required: tuple[str, ...]
    identity: tuple[str, ...]
    required_by_event: dict[str, tuple[str, ...]]
    allowed: dict[str, tuple[str, ...]]
    platforms_by_device: dict[str, tuple[str, ...]]
    patterns: dict[str, str]
    timestamps: tuple[str, ...]
    schema_version: int
    max_skew_seconds: int
    schema_json: str
    device_field: str = "device_type"
    platform_field: str = "platform"
    name_field: str = "event_name"
    version_field: str = "schema_version"
    event_time: str = "event_time"
    received_at: str = "received_at"
    scheduled_field: str = "scheduled_start_time"
    booking_event: str = "appointment_booked"
    rule_version: str = field(default=RULE_VERSION)

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def spark_schema(self) -> T.StructType:
        kinds = {"timestamp": T.TimestampType(), "int": T.IntegerType()}
        return T.StructType(
            [T.StructField(f.name, kinds.get(f.kind, T.StringType())) for f in self.fields]
        )


# The wire schema (field order and types) and the rule matrix that
# producers of this event stream already use. They must stay equal for results to match.
EVENT_NAMES = (
    "specialty_searched",
    "provider_profile_viewed",
    "appointment_slot_viewed",
    "booking_started",
    "appointment_booked",
    "checkin_started",
    "waiting_room_entered",
    "video_visit_started",
    "video_connection_failed",
    "visit_completed",
)
FIELDS = (
    Field("event_id", "string"),
    Field("event_name", "enum"),
    Field("event_time", "timestamp"),
    Field("received_at", "timestamp"),
    Field("anonymous_id", "string", nullable=True, has_default=True),
    Field("customer_id", "string", nullable=True, has_default=True),
    Field("session_id", "string"),
    Field("booking_journey_id", "string", nullable=True, has_default=True),
    Field("appointment_id", "string", nullable=True, has_default=True),
    Field("scheduled_start_time", "timestamp", nullable=True, has_default=True),
    Field("provider_id", "string", nullable=True, has_default=True),
    Field("device_type", "string"),
    Field("platform", "string"),
    Field("specialty", "string", nullable=True, has_default=True),
    Field("schema_version", "int", has_default=True),
)
REQUIRED = (
    "event_id",
    "event_name",
    "event_time",
    "received_at",
    "session_id",
    "device_type",
    "platform",
    "schema_version",
)
IDENTITY = ("anonymous_id", "customer_id")
TIMESTAMPS = ("event_time", "received_at", "scheduled_start_time")
VIEW_FIELDS = ("booking_journey_id", "provider_id", "specialty")
VISIT_FIELDS = (
    "appointment_id",
    "booking_journey_id",
    "customer_id",
    "provider_id",
    "scheduled_start_time",
    "specialty",
)
REQUIRED_BY_EVENT = {
    "specialty_searched": ("specialty",),
    "provider_profile_viewed": VIEW_FIELDS,
    "appointment_slot_viewed": VIEW_FIELDS,
    "booking_started": ("booking_journey_id", "customer_id", "provider_id", "specialty"),
    "appointment_booked": VISIT_FIELDS,
    "checkin_started": VISIT_FIELDS,
    "waiting_room_entered": VISIT_FIELDS,
    "video_visit_started": VISIT_FIELDS,
    "video_connection_failed": VISIT_FIELDS,
    "visit_completed": VISIT_FIELDS,
}
ALLOWED = {
    "device_type": ("desktop", "mobile", "tablet"),
    "platform": ("android", "ios", "web"),
    "specialty": ("dermatology", "mental_health", "pediatrics", "primary_care"),
}
PLATFORMS_BY_DEVICE = {
    "desktop": ("web",),
    "mobile": ("android", "ios", "web"),
    "tablet": ("android", "ios", "web"),
}
PATTERNS = {
    "event_id": "evt_[0-9a-f]{32}",
    "anonymous_id": "anon_[0-9a-f]{32}",
    "customer_id": "cus_[0-9]{8}",
    "session_id": "ses_[0-9a-f]{32}",
    "booking_journey_id": "bkj_[0-9a-f]{32}",
    "appointment_id": "apt_[0-9a-f]{32}",
    "provider_id": "prv_[0-9]{6}",
}
SCHEMA_VERSION = 1
MAX_SKEW_SECONDS = 300
# End of fixed values.

AVRO_KINDS = {"string": "string", "int": "int"}


def avro_schema(fields, event_names, record="ProductEvent") -> str:
    """Writer schema text for a field list, in the Avro JSON notation."""
    out = []
    for f in fields:
        if f.kind == "enum":
            kind: object = {"type": "enum", "name": "EventName", "symbols": list(event_names)}
        elif f.kind == "timestamp":
            kind = {"type": "long", "logicalType": "timestamp-micros"}
        else:
            kind = AVRO_KINDS[f.kind]
        entry: dict[str, object] = {"name": f.name, "type": ["null", kind] if f.nullable else kind}
        if f.has_default:
            entry["default"] = None if f.nullable else SCHEMA_VERSION
        out.append(entry)
    return json.dumps({"type": "record", "name": record, "fields": out})


def default_contract() -> Contract:
    return Contract(
        fields=FIELDS,
        event_names=EVENT_NAMES,
        required=REQUIRED,
        identity=IDENTITY,
        required_by_event=REQUIRED_BY_EVENT,
        allowed=ALLOWED,
        platforms_by_device=PLATFORMS_BY_DEVICE,
        patterns=PATTERNS,
        timestamps=TIMESTAMPS,
        schema_version=SCHEMA_VERSION,
        max_skew_seconds=MAX_SKEW_SECONDS,
        schema_json=avro_schema(FIELDS, EVENT_NAMES),
    )


def _field_from_avro(entry: dict) -> tuple[Field, list[str] | None]:
    kind, nullable = entry["type"], False
    if isinstance(kind, list):
        if len(kind) != 2 or kind[0] != "null":
            raise ValueError(f"Only [null, type] unions are supported: {entry['name']}")
        kind, nullable = kind[1], True
    symbols = None
    if isinstance(kind, dict) and kind.get("logicalType") == "timestamp-micros":
        name = "timestamp"
    elif isinstance(kind, dict) and kind.get("type") == "enum":
        name, symbols = "enum", kind["symbols"]
    elif kind in AVRO_KINDS:
        name = kind
    else:
        raise ValueError(f"Unsupported Avro type for {entry['name']}: {kind}")
    return Field(entry["name"], name, nullable, "default" in entry), symbols


def load_contract(schema_path: str, rules_path: str) -> Contract:
    """Contract from an Avro schema file and a JSON rule matrix (both small, driver side)."""
    schema_text = Path(schema_path).read_text(encoding="utf-8")
    rules = json.loads(Path(rules_path).read_text(encoding="utf-8"))
    parsed = [_field_from_avro(e) for e in json.loads(schema_text)["fields"]]
    symbols = next(s for _, s in parsed if s)
    contract = Contract(
        fields=tuple(f for f, _ in parsed),
        event_names=tuple(symbols),
        required=tuple(rules["global_required_fields"]),
        identity=tuple(rules["identity_at_least_one_of"]),
        required_by_event={k: tuple(v) for k, v in rules["event_required_fields"].items()},
        allowed={k: tuple(v) for k, v in rules["allowed_values"].items()},
        platforms_by_device={k: tuple(v) for k, v in rules["platforms_by_device"].items()},
        patterns=dict(rules["identifier_patterns"]),
        timestamps=tuple(rules["timestamp_fields"]),
        schema_version=rules["schema_version"],
        max_skew_seconds=rules["max_event_clock_skew_seconds"],
        schema_json=schema_text,
    )
    return contract


def contract_problems(contract: Contract) -> list[str]:
    """Names that the schema and the rule matrix do not share."""
    in_schema, in_rules = set(contract.event_names), set(contract.required_by_event)
    known = set(contract.names)
    used = set(contract.required) | set(contract.identity) | set(contract.patterns)
    used |= set(contract.allowed) | set(contract.timestamps)
    used |= {f for fs in contract.required_by_event.values() for f in fs}
    problems = [f"schema_only:{n}" for n in in_schema - in_rules]
    problems += [f"rules_only:{n}" for n in in_rules - in_schema]
    problems += [f"unknown_field:{n}" for n in used - known]
    return sorted(problems)
