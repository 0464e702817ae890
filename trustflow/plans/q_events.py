"""Deduplicated events: merge, enrichment, repair, reconciliation and replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustflow.functions import ids
from trustflow.functions.times import format_utc, seconds_between
from trustflow.operators import classify, dedup, enrich, facts, ordering, reconcile, snapshot
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.q_delivery import event_columns
from trustflow.plans.registry import query
from trustflow.session import scratch_dir
from trustflow.sources import files

_LATE = "received_at > event_time + INTERVAL 1800 SECOND"
# What the stream kept: events collected within half an hour.
_DURABLE = f"durable AS (SELECT * FROM uniq WHERE NOT ({_LATE}))"


def is_late():
    return seconds_between(F.col("received_at"), F.col("event_time")) > 1800


def durable_events(spark, sf):
    return fx.unique_events(spark, sf).where(~is_late())


@query(
    "insert_only_merge",
    f"WITH {sql.UNIQUE}, {_DURABLE} SELECT event_id, raw_record_id FROM uniq "
    "WHERE event_id NOT IN (SELECT event_id FROM durable)",
)
def insert_only_merge(spark, sf):
    inserted = dedup.insert_only(durable_events(spark, sf), fx.kept_valid(spark, sf))
    return inserted.select("event_id", "raw_record_id")


@query(
    "recon_missing_events",
    f"WITH {sql.UNIQUE}, {_DURABLE} SELECT event_id, raw_record_id FROM valid WHERE "
    "ingested_at >= TIMESTAMP '2024-01-05 00:00:00' AND ingested_at < TIMESTAMP '2024-01-25 00:00:00' "
    "AND event_id NOT IN (SELECT event_id FROM durable)",
)
def recon_missing_events(spark, sf):
    recent = reconcile.ingested_between(fx.kept_classified(spark, sf), "2024-01-05", "2024-01-25")
    recent = classify.valid_view(recent, fx.CONTRACT)
    return reconcile.missing_events(recent, durable_events(spark, sf)).select(
        "event_id", "raw_record_id"
    )


@query(
    "recon_gap",
    f"WITH {sql.UNIQUE}, {_DURABLE} SELECT (SELECT count(*) FROM uniq) AS expected_events, "
    "count(*) AS durable_events, (SELECT count(*) FROM uniq) - count(*) AS gap, "
    "(SELECT count(*) FROM uniq) - count(*) AS missing, 0::BIGINT AS unexpected FROM durable",
)
def recon_gap(spark, sf):
    return reconcile.gap(fx.kept_valid(spark, sf), durable_events(spark, sf))


@query(
    "conflicting_payloads",
    f"WITH {sql.VALID} SELECT event_id, count(*) * 2 AS deliveries FROM valid "
    "WHERE CAST(right(event_id, 9) AS BIGINT) % 3 = 0 GROUP BY event_id",
)
def conflicting_payloads(spark, sf):
    """Decoded valid deliveries, each sent once more; for a third of the events the second sending names another device type."""
    valid = fx.kept_valid(spark, sf)
    other = F.when(F.right("event_id", F.lit(9)).cast("bigint") % 3 == 0, F.lit("other")).otherwise(F.col("device_type"))
    again = valid.withColumn("device_type", other)
    return reconcile.conflicting_payloads(valid.unionByName(again), fx.CONTRACT.names)


_STATUS = (
    "CASE WHEN e.customer_id IS NULL THEN 'anonymous' WHEN c.customer_id IS NULL "
    "THEN 'customer_not_found' ELSE 'matched' END"
)


@query(
    "enrich_customers",
    f"WITH {sql.VALID}, {sql.SNAPSHOTS} SELECT raw_record_id, {_STATUS} AS customer_match_status, "
    "c.region, c.membership_plan, c.acquisition_channel, c.account_status, "
    "'v1' AS customer_snapshot_id FROM valid e LEFT JOIN v1 c ON e.customer_id = c.customer_id",
)
def enrich_customers(spark, sf):
    joined = enrich.enrich(
        fx.kept_valid(spark, sf), fx.snapshot_v1(spark, sf), "v1", row_id="raw_record_id"
    )
    return joined.select(
        "raw_record_id", "customer_match_status", *enrich.ATTRIBUTES, "customer_snapshot_id"
    )


def later_snapshot(spark, sf):
    """The second snapshot plus some of the customers that events named before they existed."""
    v2 = fx.snapshot_v2(spark, sf)
    number = ids.number_of(F.col("customer_id"), "cus_")
    arrived = v2.where(number % 20 == 9).withColumn(
        "customer_id", ids.numbered("cus_", number + 90_000_000, 8)
    )
    return v2.unionByName(arrived)


_LATER = (
    "later AS (SELECT * FROM v2 UNION ALL SELECT * REPLACE (concat('cus_', "
    "CAST(90000000 + TRY_CAST(substr(customer_id, 5) AS BIGINT) AS VARCHAR)) AS customer_id) FROM v2 "
    "WHERE TRY_CAST(substr(customer_id, 5) AS BIGINT) % 20 = 9)"
)


@query(
    "repair_missing_customers",
    f"WITH {sql.VALID}, {sql.SNAPSHOTS}, {_LATER} SELECT raw_record_id, "
    "CASE WHEN e.customer_id IS NULL THEN 'anonymous' WHEN c.customer_id IS NOT NULL OR "
    "l.customer_id IS NOT NULL THEN 'matched' ELSE 'customer_not_found' END AS customer_match_status, "
    "CASE WHEN c.customer_id IS NULL THEN l.membership_plan ELSE c.membership_plan END "
    "AS membership_plan, CASE WHEN c.customer_id IS NULL AND l.customer_id IS NOT NULL THEN 'v2' "
    "ELSE 'v1' END AS customer_snapshot_id, CASE WHEN c.customer_id IS NULL AND l.customer_id "
    "IS NOT NULL THEN epoch_us(TIMESTAMP '2024-02-01 00:00:00') END AS repaired_us, "
    "CASE WHEN c.customer_id IS NULL AND l.customer_id IS NOT NULL THEN 'customer_arrived_later' END "
    "AS repair_reason FROM valid e LEFT JOIN v1 c ON e.customer_id = c.customer_id "
    "LEFT JOIN later l ON e.customer_id = l.customer_id",
)
def repair_missing_customers(spark, sf):
    first = enrich.enrich(
        fx.kept_valid(spark, sf), fx.snapshot_v1(spark, sf), "v1", row_id="raw_record_id"
    )
    repaired = enrich.repair(
        first,
        later_snapshot(spark, sf),
        "v2",
        F.lit("2024-02-01").cast("timestamp"),
        row_id="raw_record_id",
    )
    return repaired.select(
        "raw_record_id",
        "customer_match_status",
        "membership_plan",
        "customer_snapshot_id",
        F.unix_micros("repaired_at").alias("repaired_us"),
        "repair_reason",
    )


@query(
    "not_found_rate",
    f"WITH {sql.VALID}, {sql.SNAPSHOTS} SELECT count(*) FILTER (c.customer_id IS NULL) AS not_found, "
    "count(*) AS with_customer, round(count(*) FILTER (c.customer_id IS NULL) / count(*)::DOUBLE, 6) "
    "AS rate FROM valid e LEFT JOIN v1 c ON e.customer_id = c.customer_id "
    "WHERE e.customer_id IS NOT NULL",
)
def not_found_rate(spark, sf):
    joined = enrich.enrich(
        fx.kept_valid(spark, sf), fx.snapshot_v1(spark, sf), "v1", row_id="raw_record_id"
    )
    return enrich.not_found_rate(joined).withColumn("rate", F.round("rate", 6))


@query(
    "replay_idempotent",
    f"WITH {sql.UNIQUE} SELECT count(*) AS expected_rows, count(*) AS replayed_rows, "
    "0::BIGINT AS differing FROM uniq",
)
def replay_idempotent(spark, sf):
    """Two runs of one replay into an isolated target, then promoted: readers get what was expected."""
    path = scratch_dir(spark, "replay")
    expected = fx.unique_events(spark, sf)
    for _ in range(2):
        reconcile.write_replay(expected, path, "r1")
    compared = expected.drop("processed_at")
    reconcile.promote_replay(spark, path, "r1", compared)
    current = reconcile.read_replay(spark, path, reconcile.current_replay(spark, path))
    return reconcile.compare_rows(compared, current.select(*compared.columns))


@query(
    "delivery_sequence",
    f"WITH {sql.EV} SELECT event_id, attempt, printf('delivery-%08d', row_number() OVER "
    "(ORDER BY send_at, event_id, attempt) - 1) AS delivery_id FROM ev",
)
def delivery_sequence(spark, sf):
    rows = fx.ev(spark, sf).select("send_at", "event_id", "attempt")
    numbered = ordering.with_sequence(rows, ["send_at", "event_id", "attempt"])
    return numbered.select(
        "event_id", "attempt", ids.numbered("delivery-", F.col("sequence"), 8).alias("delivery_id")
    )


@query(
    "jsonl_roundtrip",
    f"WITH {sql.UNIQUE} SELECT event_id, event_name, epoch_us(event_time) AS event_us, "
    "epoch_us(received_at) AS received_us, anonymous_id, customer_id, session_id, "
    "booking_journey_id, appointment_id, epoch_us(scheduled_start_time) AS scheduled_us, "
    "provider_id, device_type, platform, specialty, schema_version FROM uniq",
)
def jsonl_roundtrip(spark, sf):
    path = scratch_dir(spark, "events-jsonl")
    files.write_jsonl(fx.unique_events(spark, sf).select(*fx.CONTRACT.names), path)
    return files.read_jsonl(spark, path, fx.CONTRACT.spark_schema).select(*event_columns())


@query(
    "event_name_counts",
    f"WITH {sql.UNIQUE} SELECT event_name, count(*) AS events FROM uniq GROUP BY event_name",
)
def event_name_counts(spark, sf):
    return (
        fx.unique_events(spark, sf).groupBy("event_name").agg(F.count(F.lit(1)).alias("events"))
    )


_FLAGS = (
    "list_filter([CASE WHEN n % 10 = 3 THEN 'delayed' END, CASE WHEN n % 5 = 4 "
    "THEN 'reorder_candidate' END, CASE WHEN wire_kind <> 'ok' THEN 'corrupt' END, "
    "CASE WHEN attempt = 1 THEN 'duplicate' END], lambda x: x IS NOT NULL)"
)


@query(
    "flag_counts",
    f"WITH {sql.EV} SELECT flag, count(*) AS deliveries FROM (SELECT unnest({_FLAGS}) AS flag FROM ev) "
    "GROUP BY flag",
)
def flag_counts(spark, sf):
    flags = F.array_compact(
        F.array(
            F.when(F.col("n") % 10 == 3, "delayed"),
            F.when(F.col("n") % 5 == 4, "reorder_candidate"),
            F.when(F.col("wire_kind") != "ok", "corrupt"),
            F.when(F.col("attempt") == 1, "duplicate"),
        )
    )
    return (
        fx.ev(spark, sf)
        .select(F.explode(flags).alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("deliveries"))
    )


_CORRUPT = (
    "codes IN ('KAFKA_TOMBSTONE', 'FRAME_TRUNCATED', 'MAGIC_BYTE_INVALID', 'SCHEMA_ID_UNKNOWN', "
    "'WRITER_SCHEMA_UNSUPPORTED', 'AVRO_DECODE_FAILED', 'AVRO_TRAILING_BYTES')"
)


@query(
    "delivery_manifest",
    f"WITH {sql.DELIVERIES} SELECT count(*) AS expected_deliveries, "
    "count(DISTINCT event_id) FILTER (route = 'valid') AS expected_valid_unique_events, "
    f"count(*) FILTER ({_CORRUPT}) AS expected_corrupt_deliveries, "
    "count(*) FILTER (route = 'quarantine') AS expected_quarantined FROM deliveries",
)
def delivery_manifest(spark, sf):
    """One row of counts per event first, then the totals, so distinct ids need no second pass."""
    rows = fx.kept_classified(spark, sf)
    frame_faults = F.arrays_overlap(
        "error_codes",
        F.array(
            *[
                F.lit(c)
                for c in (
                    "KAFKA_TOMBSTONE",
                    "FRAME_TRUNCATED",
                    "MAGIC_BYTE_INVALID",
                    "SCHEMA_ID_UNKNOWN",
                    "WRITER_SCHEMA_UNSUPPORTED",
                    "AVRO_DECODE_FAILED",
                    "AVRO_TRAILING_BYTES",
                )
            ]
        ),
    )
    # Deliveries without an event are spread by their own id instead of sharing one key.
    key = F.coalesce(F.col("event.event_id"), F.col("raw_record_id"))
    per_event = rows.groupBy(key.alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("route") == "valid").alias("ok"),
        F.count_if(frame_faults).alias("corrupt"),
        F.count_if(F.col("route") == "quarantine").alias("bad"),
    )
    return per_event.agg(
        F.sum("n").alias("expected_deliveries"),
        F.count_if("ok").alias("expected_valid_unique_events"),
        F.sum("corrupt").alias("expected_corrupt_deliveries"),
        F.sum("bad").alias("expected_quarantined"),
    )


@query(
    "utc_format",
    f"WITH {sql.EV} SELECT concat(event_id, ':', attempt) AS id, "
    "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time_text, "
    "strftime(scheduled_start_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS scheduled_text FROM ev",
)
def utc_format(spark, sf):
    return fx.ev(spark, sf).select(
        F.concat_ws(":", "event_id", "attempt").alias("id"),
        format_utc(F.col("event_time")).alias("event_time_text"),
        format_utc(F.col("scheduled_start_time")).alias("scheduled_text"),
    )


@query(
    "hash_identifier",
    "SELECT event_id AS n, concat('evt_', substr(sha256(concat_ws(':', 42, user_id, event_id)), 1, 32)) "
    "AS hashed_id FROM events",
)
def hash_identifier(spark, sf):
    events = fx.table(spark, sf, "events")
    hashed = ids.hash_identifier("evt", F.lit(42), F.col("user_id"), F.col("event_id"))
    return events.select(F.col("event_id").alias("n"), hashed.alias("hashed_id"))


@query(
    "id_codec",
    "SELECT c_custkey, printf('cus_%08d', c_custkey + 1) AS next_id, "
    "c_custkey AS decoded FROM customer",
)
def id_codec(spark, sf):
    rows = fx.table(spark, sf, "customer").select(
        "c_custkey", ids.numbered("cus_", F.col("c_custkey"), 8).alias("customer_id")
    )
    number = ids.number_of(F.col("customer_id"), "cus_")
    return rows.select(
        "c_custkey", ids.numbered("cus_", number + 1, 8).alias("next_id"), number.alias("decoded")
    )


@query(
    "cohort_dates",
    f"WITH {sql.UNIQUE} SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS cohort_date, "
    "count(*) AS views FROM uniq WHERE event_name = 'provider_profile_viewed' GROUP BY 1",
)
def cohort_dates(spark, sf):
    views = fx.unique_events(spark, sf).where("event_name = 'provider_profile_viewed'")
    return views.groupBy(F.to_date("event_time").cast("string").alias("cohort_date")).agg(
        F.count(F.lit(1)).alias("views")
    )


__all__ = ["durable_events", "is_late", "later_snapshot", "facts", "snapshot"]
