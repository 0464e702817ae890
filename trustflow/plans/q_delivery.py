"""Raw rows, framing, decoding and routing of the derived deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustflow.functions import ids
from trustflow.functions.canonical import event_json
from trustflow.operators import bronze, classify, dedup, enrich, facts, reconcile, snapshot
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.registry import query



def codes():
    return F.array_join("error_codes", ",").alias("codes")


_HINT = (
    "CASE WHEN wire_kind IN ('tombstone', 'short', 'bad_magic') THEN NULL "
    "WHEN wire_kind = 'unknown_schema' THEN 404 WHEN wire_kind = 'other_schema' THEN 2 ELSE 1 END"
)


@query(
    "bronze_rows",
    f"WITH {sql.EV} SELECT concat(topic, ':', part, ':', off) AS raw_record_id, topic, "
    "part AS partition, CAST(off AS BIGINT) AS \"offset\", booking_journey_id AS key_text, "
    f"CAST({_HINT} AS BIGINT) AS schema_id, concat('delivery-', off) AS header_text, "
    "epoch_us(send_at) AS kafka_us, epoch_us(ingested_at) AS ingested_us, "
    "wire_kind <> 'tombstone' AS has_value FROM ev",
)
def bronze_rows(spark, sf):
    return fx.deliveries(spark, sf).select(
        "raw_record_id",
        "topic",
        "partition",
        "offset",
        F.decode("key", "UTF-8").alias("key_text"),
        "schema_id",
        F.decode(F.col("headers")[0]["value"], "UTF-8").alias("header_text"),
        F.unix_micros("kafka_timestamp").alias("kafka_us"),
        F.unix_micros("ingested_at").alias("ingested_us"),
        F.col("value").isNotNull().alias("has_value"),
    )


_BODY = (
    "37 + 1 + 8 + 8 + CASE WHEN anonymous_id IS NULL THEN 1 ELSE 2 + length(anonymous_id) END "
    "+ CASE WHEN customer_id IS NULL THEN 1 ELSE 2 + length(customer_id) END + 37 + 38 "
    "+ CASE WHEN appointment_id IS NULL THEN 1 ELSE 38 END "
    "+ CASE WHEN scheduled_start_time IS NULL THEN 1 ELSE 9 END + 12 + 1 + length(device_type) "
    "+ 1 + length(platform) + 2 + length(specialty) + 1"
)


@query(
    "frame_header",
    f"WITH {sql.EV} SELECT part AS partition, CAST(off AS BIGINT) AS \"offset\", "
    "CASE WHEN wire_kind = 'tombstone' THEN NULL WHEN wire_kind = 'bad_magic' THEN '01' "
    "ELSE '00' END AS magic_hex, CASE wire_kind WHEN 'tombstone' THEN NULL WHEN 'short' THEN '0000' "
    "WHEN 'unknown_schema' THEN '00000194' WHEN 'other_schema' THEN '00000002' "
    "ELSE '00000001' END AS schema_id_hex, CAST(CASE wire_kind WHEN 'tombstone' THEN NULL "
    "WHEN 'short' THEN 0 WHEN 'unknown_schema' THEN 404 WHEN 'other_schema' THEN 2 ELSE 1 END "
    f"AS BIGINT) AS schema_id, CAST({_HINT} AS BIGINT) AS schema_id_hint, "
    "CAST(CASE wire_kind WHEN 'tombstone' THEN NULL WHEN 'short' THEN 0 WHEN 'truncated' THEN 25 "
    f"WHEN 'trailing' THEN {_BODY} + 5 ELSE {_BODY} END AS BIGINT) AS body_length FROM ev",
)
def frame_header(spark, sf):
    return bronze.frame_header(fx.deliveries(spark, sf)).select(
        "partition",
        "offset",
        "magic_hex",
        "schema_id_hex",
        "schema_id",
        "schema_id_hint",
        F.col("body_length").cast("bigint").alias("body_length"),
    )


@query(
    "coordinate_lookup",
    f"WITH {sql.EV} SELECT concat(topic, ':', part, ':', off) AS raw_record_id, part AS partition, "
    "CAST(off AS BIGINT) AS \"offset\" FROM ev WHERE off = (SELECT max(off) FROM ev) "
    "ORDER BY part, off",
)
def coordinate_lookup(spark, sf):
    raw = fx.deliveries(spark, sf)
    last = raw.agg(
        F.max("offset").alias("o"), F.max_by("partition", "offset").alias("p")
    ).first()
    found = bronze.exactly_one(bronze.at_coordinates(raw, "events", last.p, last.o))
    return found.select("raw_record_id", "partition", "offset").orderBy("partition", "offset")


@query(
    "bounded_offset_range",
    f"WITH {sql.EV} SELECT part AS partition, count(*) AS deliveries, CAST(min(off) AS BIGINT) AS first_offset, "
    "CAST(max(off) AS BIGINT) AS last_offset FROM ev WHERE off >= 10 + part GROUP BY part",
)
def bounded_offset_range(spark, sf):
    """Each partition from its own start to its own end, the last delivery included."""
    raw = fx.deliveries(spark, sf)
    ends = raw.groupBy("partition").agg((F.max("offset") + 1).alias("end")).collect()  # a row per partition
    return (
        bronze.offset_ranges(raw, {r.partition: (10 + r.partition, r.end) for r in ends})
        .groupBy("partition")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )


_EVENT_TEXT = (
    "event_id, event_name, epoch_us(event_time) AS event_us, epoch_us(received_at) AS received_us, "
    "anonymous_id, customer_id, session_id, booking_journey_id, appointment_id, "
    "epoch_us(scheduled_start_time) AS scheduled_us, provider_id, device_type, platform, "
    "specialty, schema_version"
)


def event_columns():
    return [
        "event_id",
        "event_name",
        F.unix_micros("event_time").alias("event_us"),
        F.unix_micros("received_at").alias("received_us"),
        "anonymous_id",
        "customer_id",
        "session_id",
        "booking_journey_id",
        "appointment_id",
        F.unix_micros("scheduled_start_time").alias("scheduled_us"),
        "provider_id",
        "device_type",
        "platform",
        "specialty",
        "schema_version",
    ]


_LOST = ", ".join(
    f"CASE WHEN readable THEN {c} END AS {c}"
    for c in (
        "event_id",
        "event_name",
        "event_time",
        "received_at",
        "anonymous_id",
        "customer_id",
        "session_id",
        "booking_journey_id",
        "appointment_id",
        "scheduled_start_time",
        "provider_id",
        "device_type",
        "platform",
        "specialty",
        "schema_version",
    )
)


@query(
    "decode_flatten",
    f"WITH {sql.EV}, framed AS (SELECT *, wire_kind <> 'truncated' AND "
    "event_name <> 'appointment_refunded' AS readable FROM ev "
    "WHERE wire_kind IN ('ok', 'truncated', 'trailing')) "
    f"SELECT part AS partition, CAST(off AS BIGINT) AS \"offset\", {_EVENT_TEXT} FROM "
    f"(SELECT part, off, {_LOST} FROM framed)",
)
def decode_flatten(spark, sf):
    decoded = classify.decode_flatten(fx.deliveries(spark, sf), 1, fx.CONTRACT)
    return decoded.select("partition", "offset", *event_columns())


@query(
    "classify_deliveries",
    f"WITH {sql.DELIVERIES} SELECT raw_record_id, CAST({_HINT} AS BIGINT) AS schema_id, "
    "'1.0.0' AS rule_version, route, codes, codes NOT IN ('KAFKA_TOMBSTONE', 'FRAME_TRUNCATED', "
    "'MAGIC_BYTE_INVALID', 'SCHEMA_ID_UNKNOWN', 'WRITER_SCHEMA_UNSUPPORTED', 'AVRO_DECODE_FAILED') "
    "AS has_event, epoch_us(processed_at) AS processed_us FROM deliveries",
)
def classify_deliveries(spark, sf):
    return fx.classified(spark, sf).select(
        "raw_record_id",
        "schema_id",
        "rule_version",
        "route",
        codes(),
        F.col("event_json").isNotNull().alias("has_event"),
        F.unix_micros("processed_at").alias("processed_us"),
    )


@query("validated_view", f"WITH {sql.VALID} SELECT raw_record_id, {_EVENT_TEXT} FROM valid")
def validated_view(spark, sf):
    view = classify.valid_view(fx.classified(spark, sf), fx.CONTRACT, source="event_json")
    return view.select("raw_record_id", *event_columns())


@query(
    "quarantine_view",
    f"WITH {sql.DELIVERIES} SELECT raw_record_id, codes FROM deliveries WHERE route = 'quarantine'",
)
def quarantine_view(spark, sf):
    return classify.quarantine_view(fx.classified(spark, sf)).select("raw_record_id", codes())


def _iso(c: str) -> str:
    return (
        f"CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00') "
        f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
    )


def _member(name: str) -> str:
    if name == "schema_version":
        return f"concat('\"{name}\": ', coalesce(CAST({name} AS VARCHAR), 'null'))"
    text = _iso(name) if name in fx.CONTRACT.timestamps else name
    return f"concat('\"{name}\": ', coalesce('\"' || {text} || '\"', 'null'))"


# The given data need no escapes; those are tested against another JSON writer.
_JSON = ", ".join(_member(c) for c in sorted(fx.CONTRACT.names))


@query(
    "canonical_json",
    f"WITH {sql.EV} SELECT concat(event_id, ':', attempt) AS id, "
    f"concat('{{', concat_ws(', ', {_JSON}), '}}') AS event_json FROM ev",
)
def canonical_json(spark, sf):
    rows = fx.ev(spark, sf).withColumn("event", F.struct(*fx.CONTRACT.names))
    return rows.select(
        F.concat_ws(":", "event_id", "attempt").alias("id"),
        event_json(F.col("event"), fx.CONTRACT).alias("event_json"),
    )


# Blank out the preferred keys so that every step of the fallback chain is used.
_KEYS = {
    "booking_journey_id": "CASE WHEN n % 5 > 0 THEN '' ELSE booking_journey_id END",
    "appointment_id": "CASE WHEN n % 5 > 1 THEN NULL ELSE appointment_id END",
    "customer_id": "CASE WHEN n % 5 > 2 THEN '' ELSE customer_id END",
    "anonymous_id": "CASE WHEN n % 5 > 3 THEN NULL ELSE anonymous_id END",
}


@query(
    "partition_key",
    f"WITH {sql.EV} SELECT concat(event_id, ':', attempt) AS id, coalesce("
    + ", ".join(f"nullif({e}, '')" for e in _KEYS.values())
    + ", session_id) AS partition_key FROM ev",
)
def partition_key(spark, sf):
    rows = fx.ev(spark, sf)
    blanked = rows.select(
        "event_id", "attempt", "session_id", *[F.expr(e).alias(n) for n, e in _KEYS.items()]
    )
    return blanked.select(
        F.concat_ws(":", "event_id", "attempt").alias("id"),
        ids.partition_key().alias("partition_key"),
    )


@query(
    "as_of_cutoff",
    f"WITH {sql.EV} SELECT event_name, count(*) AS deliveries, epoch_us(max(received_at)) AS last_us "
    "FROM ev WHERE received_at <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY event_name",
)
def as_of_cutoff(spark, sf):
    cut = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return (
        facts.visible(fx.ev(spark, sf), cut)
        .groupBy("event_name")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.unix_micros(F.max("received_at")).alias("last_us"),
        )
    )


@query(
    "recon_ingest_window",
    f"WITH {sql.VALID} SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, "
    "count(*) AS deliveries FROM valid WHERE ingested_at >= TIMESTAMP '2024-01-10 00:00:00' "
    "AND ingested_at < TIMESTAMP '2024-01-12 00:00:00' GROUP BY 1",
)
def recon_ingest_window(spark, sf):
    rows = reconcile.ingested_between(fx.kept_classified(spark, sf), "2024-01-10", "2024-01-12")
    rows = classify.valid_view(rows, fx.CONTRACT)
    return rows.groupBy(F.to_date("event_time").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("deliveries")
    )


@query(
    "eligible_customers",
    f"WITH {sql.SNAPSHOTS} SELECT customer_id, region, epoch_us(created_at) AS created_us FROM v2 "
    "WHERE NOT is_deleted AND account_status = 'active' "
    "AND created_at <= TIMESTAMP '2023-06-01 00:00:00'",
)
def eligible_customers(spark, sf):
    rows = snapshot.eligible(
        fx.snapshot_v2(spark, sf), snapshot.SnapshotSpec(), "2023-06-01 00:00:00"
    )
    return rows.select("customer_id", "region", F.unix_micros("created_at").alias("created_us"))


@query(
    "route_counts",
    f"WITH {sql.DELIVERIES} SELECT route, count(*) AS deliveries FROM deliveries GROUP BY route",
)
def route_counts(spark, sf):
    return fx.classified(spark, sf).groupBy("route").agg(F.count(F.lit(1)).alias("deliveries"))


@query(
    "error_distribution",
    f"WITH {sql.DELIVERIES} SELECT code, count(*) AS deliveries FROM (SELECT "
    "unnest(string_split(codes, ',')) AS code FROM deliveries WHERE route = 'quarantine') GROUP BY code",
)
def error_distribution(spark, sf):
    return (
        fx.classified(spark, sf)
        .select(F.explode("error_codes").alias("code"))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("deliveries"))
    )


@query(
    "distinct_schema_ids",
    f"WITH {sql.EV} SELECT DISTINCT CAST({_HINT} AS BIGINT) AS schema_id FROM ev "
    f"WHERE {_HINT} IS NOT NULL",
)
def distinct_schema_ids(spark, sf):
    return classify.distinct_schema_ids(fx.deliveries(spark, sf))


@query(
    "valid_but_imperfect",
    f"WITH {sql.VALID}, {sql.SNAPSHOTS} SELECT "
    "count(*) FILTER (event_time + INTERVAL 1800 SECOND < received_at) AS late, "
    "count(*) - count(DISTINCT event_id) AS duplicates, "
    "count(*) FILTER (customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM v1)) "
    "AS missing_customer, count(*) AS valid FROM valid",
)
def valid_but_imperfect(spark, sf):
    rows = enrich.enrich(fx.kept_valid(spark, sf), fx.snapshot_v1(spark, sf), "v1")
    late = F.unix_micros("received_at") - F.unix_micros("event_time") > 1_800_000_000
    lost = F.col("customer_match_status") == enrich.NOT_FOUND
    per_id = rows.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(late).alias("l"), F.count_if(lost).alias("m")
    )
    return per_id.agg(
        F.sum("l").alias("late"),
        F.sum(F.col("n") - 1).alias("duplicates"),
        F.sum("m").alias("missing_customer"),
        F.sum("n").alias("valid"),
    )


@query(
    "batch_dedup",
    f"WITH {sql.UNIQUE} SELECT event_id, raw_record_id, epoch_us(ingested_at) AS ingested_us FROM uniq",
)
def batch_dedup(spark, sf):
    return dedup.first_delivery(fx.kept_valid(spark, sf)).select(
        "event_id", "raw_record_id", F.unix_micros("ingested_at").alias("ingested_us")
    )
