"""Structural stages and golden cases of events that arrive as JSON text."""

import json

import pytest
from wire_helper import CONTRACT, booking

from trustflow.contract import contract_problems, load_contract
from trustflow.operators.json_events import validate_json


def codes(spark, *events):
    texts = [(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    df = spark.createDataFrame(texts, "i INT, json STRING")
    return [r.error_codes for r in validate_json(df, "json", CONTRACT).orderBy("i").collect()]


def view(**changes):
    event = booking(
        event_name="provider_profile_viewed",
        customer_id=None,
        appointment_id=None,
        scheduled_start_time=None,
    )
    event.update(changes)
    return event


def test_valid_events(spark):
    done = booking(event_name="visit_completed", event_time="2025-03-06T12:30:00Z",
                   received_at="2025-03-06T12:30:02Z")
    assert codes(spark, booking(), view(), done) == [[], [], []]


def test_golden_invalid_events(spark):
    search = view(event_name="specialty_searched", booking_journey_id=None, provider_id=None)
    cases = [
        (booking(appointment_id=None), "FIELD_REQUIRED:appointment_id"),
        (view(device_type="desktop", platform="android"), "DEVICE_PLATFORM_MISMATCH"),
        (view(event_time="2025-03-04T09:16:00Z"), "EVENT_TIME_TOO_FAR_IN_FUTURE"),
        (booking(customer_id="customer-42"), "IDENTIFIER_FORMAT_INVALID:customer_id"),
        ({**search, "anonymous_id": None}, "IDENTITY_REQUIRED"),
        (booking(scheduled_start_time="2025-03-04T09:00:00Z"), "SCHEDULED_START_BEFORE_BOOKING"),
        (view(event_name="appointment_refunded"), "AVRO_SCHEMA_INVALID"),
        (view(platform="windows"), "DEVICE_PLATFORM_MISMATCH,VALUE_NOT_ALLOWED:platform"),
        (view(device_type="watch"), "VALUE_NOT_ALLOWED:device_type"),
        (view(schema_version=2), "SCHEMA_VERSION_UNSUPPORTED"),
    ]
    assert codes(spark, *[e for e, _ in cases]) == [c.split(",") for _, c in cases]


def test_structure_stops_at_the_first_failing_stage(spark):
    broken = view(event_time="2025-03-04T09:10:00", device_type=5)
    missing = {k: v for k, v in view().items() if k != "session_id"}
    cases = [
        ({**broken, "note": 1}, ["AVRO_SCHEMA_INVALID"]),
        (broken, ["TIMESTAMP_INVALID:event_time"]),
        (view(device_type=5), ["AVRO_SCHEMA_INVALID"]),
        (view(session_id=None), ["AVRO_SCHEMA_INVALID"]),
        (missing, ["AVRO_SCHEMA_INVALID"]),
        (view(event_time=None), ["AVRO_SCHEMA_INVALID"]),
        (view(schema_version=None), ["AVRO_SCHEMA_INVALID"]),
        (view(schema_version=True), ["AVRO_SCHEMA_INVALID"]),
        (view(schema_version="1"), ["AVRO_SCHEMA_INVALID"]),
        (view(schema_version=2**31), ["AVRO_SCHEMA_INVALID"]),
        ("[1, 2]", ["AVRO_SCHEMA_INVALID"]),
        ("not json", ["AVRO_SCHEMA_INVALID"]),
    ]
    assert codes(spark, *[e for e, _ in cases]) == [c for _, c in cases]


def test_repeated_keys_and_broken_text(spark):
    good = json.dumps(view())
    later = good[:-1] + ', "device_type": 5}'
    mended = '{"device_type": 5, ' + good[1:]
    assert codes(spark, later, mended, "{}", "{", "null") == [["AVRO_SCHEMA_INVALID"], [], *[["AVRO_SCHEMA_INVALID"]] * 3]


def test_text_is_parsed_once(spark):
    df = validate_json(spark.createDataFrame([("{}",)], "json STRING"), "json", CONTRACT)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "json_object_keys" not in plan


def test_absent_fields_with_defaults(spark):
    short = {k: v for k, v in view().items() if k not in ("appointment_id", "schema_version")}
    assert codes(spark, short) == [["FIELD_REQUIRED:schema_version", "SCHEMA_VERSION_UNSUPPORTED"]]


@pytest.mark.parametrize(
    "text,ok",
    [
        ("2025-03-04T09:10:00Z", True),
        ("2025-03-04 09:10:00+00:00", True),
        ("2025-03-04T09:10:00.123456-00:00", True),
        ("2025-03-04T09:10Z", True),
        ("2025-03-04T09Z", True),
        ("20250304T091000.5+0000", True),
        ("2025-03-04T09:10:00,123456789+00", True),
        ("2025-03-04Z", False),
        ("2025-0304T09:10:00Z", False),
        ("2025-03-04T25:10:00Z", False),
        ("2025-03-04T09:10:00", False),
        ("2025-03-04T09:10:00+02:00", False),
        ("2025-02-30T09:10:00Z", False),
        ("2025-03-04T09:10:00z", False),
        ("2025-03-04T09:10:00Z\n", False),
        ("yesterday", False),
        ("", False),
        (1741079400, False),
    ],
)
def test_utc_timestamps(spark, text, ok):
    want = [] if ok else ["TIMESTAMP_INVALID:event_time"]
    assert codes(spark, view(event_time=text)) == [want]


def test_contract_is_symmetric_and_loads_from_files(tmp_path):
    assert contract_problems(CONTRACT) == []
    rules = {
        "schema_version": 1,
        "global_required_fields": list(CONTRACT.required),
        "identity_at_least_one_of": list(CONTRACT.identity),
        "timestamp_fields": list(CONTRACT.timestamps),
        "max_event_clock_skew_seconds": 300,
        "allowed_values": {k: list(v) for k, v in CONTRACT.allowed.items()},
        "platforms_by_device": {k: list(v) for k, v in CONTRACT.platforms_by_device.items()},
        "identifier_patterns": {k: f"^{v}$" for k, v in CONTRACT.patterns.items()},
        "event_required_fields": {k: list(v) for k, v in CONTRACT.required_by_event.items()},
    }
    (tmp_path / "schema.avsc").write_text(CONTRACT.schema_json)
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    loaded = load_contract(str(tmp_path / "schema.avsc"), str(tmp_path / "rules.json"))
    assert loaded.fields == CONTRACT.fields
    assert loaded.event_names == CONTRACT.event_names
    assert loaded.required_by_event == CONTRACT.required_by_event
    del rules["event_required_fields"]["visit_completed"]
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    broken = load_contract(str(tmp_path / "schema.avsc"), str(tmp_path / "rules.json"))
    assert contract_problems(broken) == ["schema_only:visit_completed"]
