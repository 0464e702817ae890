"""Classification of single frames, the decoder's edges and the failure of outages."""

import json
import struct

import pytest
from pyspark.sql import functions as F
from wire_helper import CONTRACT, booking, datum, frame, varint

from trustflow.functions import ids
from trustflow.operators import bronze, classify
from trustflow.sources.kafka import KAFKA_DDL

SCHEMAS = {1: CONTRACT.schema_json, 2: '{"type": "string"}', 404: None, 2**32 - 1: CONTRACT.schema_json}


def classified(spark, values, schemas=None):
    rows = [("t", 0, i, None, v, None, None, 0) for i, v in enumerate(values)]
    raw = spark.createDataFrame(rows, KAFKA_DDL)
    catalog = classify.catalog_rows(spark, SCHEMAS if schemas is None else schemas)
    return classify.classify(bronze.raw_deliveries(raw), catalog, CONTRACT)


def outcomes(spark, values, schemas=None):
    return [
        (r.route, r.error_codes, r.event_json)
        for r in classified(spark, values, schemas).orderBy("offset").collect()
    ]


def head(schema_id=1):
    return b"\x00" + struct.pack(">I", schema_id)


def test_transport_and_decode_codes(spark):
    good = frame(booking())
    cases = [
        (None, "KAFKA_TOMBSTONE", False),
        (b"", "FRAME_TRUNCATED", False),
        (b"\x00\x00\x00\x00", "FRAME_TRUNCATED", False),
        (b"plain text", "MAGIC_BYTE_INVALID", False),
        (head(), "AVRO_DECODE_FAILED", False),
        (good[:-1], "AVRO_DECODE_FAILED", False),
        (frame(booking(), 404), "SCHEMA_ID_UNKNOWN", False),
        (frame(booking(), 2), "WRITER_SCHEMA_UNSUPPORTED", False),
        (good + b"extra", "AVRO_TRAILING_BYTES", True),
        (frame(booking(event_name=10)), "AVRO_DECODE_FAILED", False),
        (frame(booking(event_name=-1)), "AVRO_DECODE_FAILED", False),
        (frame(booking(session_id=b"\xff\xfe")), "AVRO_DECODE_FAILED", False),
        (frame(booking(event_time=2**62)), "AVRO_DECODE_FAILED", False),
        (head() + varint(-3), "AVRO_DECODE_FAILED", False),
        (head() + b"\xff" * 12, "AVRO_DECODE_FAILED", False),
        (frame(booking(schema_version=2**31)), "AVRO_SCHEMA_INVALID", True),
    ]
    got = outcomes(spark, [v for v, _, _ in cases])
    assert [(codes, text is not None) for _, codes, text in got] == [
        ([code], has_event) for _, code, has_event in cases
    ]
    assert {route for route, _, _ in got} == {"quarantine"}


def test_valid_frame_keeps_identity_and_large_schema_ids(spark):
    values = [frame(booking()), frame(booking(), 2**32 - 1), frame(booking(specialty="pédiatrie"))]
    got = outcomes(spark, values)
    assert [g[0] for g in got] == ["valid", "valid", "quarantine"]
    event = json.loads(got[0][2])
    assert event["event_id"] == booking()["event_id"]
    assert event["event_time"] == "2025-03-04T09:10:00+00:00"
    assert list(event) == sorted(event)
    assert json.loads(got[2][2])["specialty"] == "pédiatrie"
    ids = [r.schema_id for r in classified(spark, values).orderBy("offset").collect()]
    assert ids == [1, 2**32 - 1, 1]


def test_business_errors_accumulate_sorted(spark):
    bad = booking(
        appointment_id=None, device_type="desktop", event_time="2025-03-04T09:30:00Z"
    )
    assert outcomes(spark, [frame(bad)])[0][1] == [
        "DEVICE_PLATFORM_MISMATCH",
        "EVENT_TIME_TOO_FAR_IN_FUTURE",
        "FIELD_REQUIRED:appointment_id",
    ]


def test_late_duplicate_and_unknown_customer_stay_valid(spark):
    late = frame(booking(received_at="2025-03-04T09:45:00Z", customer_id="cus_99999999"))
    assert [g[0] for g in outcomes(spark, [late, late])] == ["valid", "valid"]


def test_boundaries_are_strict(spark):
    on_limit = booking(event_time="2025-03-04T09:15:03Z")
    past = booking(event_time="2025-03-04T09:15:03.000001Z")
    same = booking(scheduled_start_time="2025-03-04T09:10:00Z")
    before = booking(scheduled_start_time="2025-03-04T09:09:59.999999Z")
    got = outcomes(spark, [frame(e) for e in (on_limit, past, same, before)])
    assert [g[1] for g in got] == [
        [],
        ["EVENT_TIME_TOO_FAR_IN_FUTURE"],
        [],
        ["SCHEDULED_START_BEFORE_BOOKING"],
    ]


def test_empty_text_is_missing_for_required_but_not_allowed_for_domains(spark):
    got = outcomes(spark, [frame(booking(specialty="")), frame(booking(customer_id="", anonymous_id=""))])
    assert got[0][1] == ["FIELD_REQUIRED:specialty", "VALUE_NOT_ALLOWED:specialty"]
    assert got[1][1] == ["FIELD_REQUIRED:customer_id", "IDENTITY_REQUIRED"]


def test_trailing_newline_fails_identifier_format(spark):
    got = outcomes(spark, [frame(booking(provider_id="prv_000007\n"))])
    assert got[0][1] == ["IDENTIFIER_FORMAT_INVALID:provider_id"]


def test_unresolved_schema_fails_the_batch(spark):
    with pytest.raises(Exception, match="Schema was not resolved"):
        outcomes(spark, [frame(booking(), 77)])


def test_schema_outage_and_guard_stop_the_batch(spark):
    rows = [("t", 0, i, None, frame(booking(), i + 1), None, None, 0) for i in range(3)]
    deliveries = bronze.raw_deliveries(spark.createDataFrame(rows, KAFKA_DDL))

    def outage(schema_id):
        raise ConnectionError("registry is down")

    with pytest.raises(ConnectionError):
        classify.resolve_schemas(deliveries, outage)
    with pytest.raises(ValueError, match="more than 2 writer schemas"):
        classify.resolve_schemas(deliveries, lambda i: None, limit=2)


def test_equal_schema_in_other_notation_is_supported(spark):
    spaced = json.dumps(json.loads(CONTRACT.schema_json), indent=2, sort_keys=True)
    assert outcomes(spark, [frame(booking())], {1: spaced})[0][0] == "valid"


def test_decoder_matches_on_many_sliced_batches(spark):
    names = CONTRACT.event_names
    events = [
        booking(
            event_id=f"evt_{i:032x}",
            event_name=names[i % 10],
            anonymous_id=None if i % 3 == 0 else "anon_" + "9" * (i % 200),
            scheduled_start_time=None if i % 4 == 0 else -i * 10**9,
        )
        for i in range(500)
    ]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = classified(spark, [frame(e) for e in events]).orderBy("offset")
        got = rows.select(
            "event.event_id",
            "event.event_name",
            "event.anonymous_id",
            F.unix_micros("event.scheduled_start_time").alias("s"),
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [tuple(r) for r in got] == [
        (e["event_id"], e["event_name"], e["anonymous_id"], e["scheduled_start_time"]) for e in events
    ]
    assert len(datum(events[5])) > 100


def test_a_catalog_of_many_ids_loses_none(spark):
    raw = spark.createDataFrame([("t", 0, 0, None, frame(booking(), 250), None, None, 0)], KAFKA_DDL)
    catalog = classify.catalog_rows(spark, {i: CONTRACT.schema_json for i in range(1, 301)})
    assert classify.classify(bronze.raw_deliveries(raw), catalog, CONTRACT).first().route == "valid"


def test_long_numbers_stay_whole(spark):
    df = spark.createDataFrame([(123456789, "cus_123456789"), (7, "cus_1234567890123456789012345678"), (8, "abc_5"), (9, "cus_1x")], "n BIGINT, id STRING")
    got = df.select(ids.numbered("delivery-", F.col("n"), 8), ids.number_of(F.col("id"), "cus_")).collect()
    assert [tuple(r) for r in got] == [("delivery-123456789", 123456789), ("delivery-00000007", None), ("delivery-00000008", None), ("delivery-00000009", None)]
