"""Small cases for merges, enrichment, facts and integrity rules."""

from pyspark.sql import functions as F

from trustflow.operators import dedup, enrich, facts, marts, merge, ordering, reconcile


def test_upsert_ties_overwrite_and_older_rows_do_not(spark):
    ddl = "k STRING, v STRING, updated_at INT"
    target = spark.createDataFrame([("a", "old", 5), ("b", "old", 5), ("c", "old", 5)], ddl)
    source = spark.createDataFrame([("a", "new", 5), ("b", "new", 4), ("d", "new", 1)], ddl)
    got = {r.k: r.v for r in merge.upsert_stale_guard(target, source, "k").collect()}
    assert got == {"a": "new", "b": "old", "c": "old", "d": "new"}


def test_type1_keeps_tombstones_and_absent_rows(spark):
    ddl = "k STRING, is_deleted BOOLEAN"
    target = spark.createDataFrame([("gone", True), ("kept", False), ("closed", False)], ddl)
    snapshot = spark.createDataFrame([("closed", True), ("new", False)], ddl)
    got = {r.k: r.is_deleted for r in merge.type1_merge(target, snapshot, "k").collect()}
    assert got == {"gone": True, "kept": False, "closed": True, "new": False}


DIM = "customer_id STRING, region STRING, membership_plan STRING, acquisition_channel STRING, account_status STRING"


def test_enrichment_without_broadcast_spreads_rows_without_customer(spark):
    events = spark.range(4000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("c"), F.col("id") % 10)).alias("customer_id"),
    )
    dim = spark.createDataFrame([(f"c{i}", "west", "basic", "organic", "active") for i in (0, 2, 4)], DIM)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    try:
        joined = enrich.enrich(events, dim, "s1").withColumn("p", F.spark_partition_id())
        counts = {r.customer_match_status: r["count"] for r in joined.groupBy("customer_match_status").count().collect()}
        parts = joined.where("customer_id IS NULL").groupBy("p").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert counts == {"anonymous": 2000, "matched": 1200, "customer_not_found": 800}
    assert len(parts) == 4 and max(r["count"] for r in parts) < 700


def test_repair_never_rewrites_matched_rows(spark):
    events = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "event_id STRING, customer_id STRING")
    first = spark.createDataFrame([("a", "west", "basic", "organic", "active")], DIM)
    later = spark.createDataFrame(
        [("a", "south", "premium", "organic", "active"), ("b", "south", "premium", "organic", "active")], DIM
    )
    at = F.lit("2025-01-01").cast("timestamp")
    once = enrich.repair(enrich.enrich(events, first, "s1"), later, "s2", at)
    rows = {r.event_id: (r.region, r.customer_snapshot_id, r.repair_reason) for r in once.collect()}
    assert rows == {
        "1": ("west", "s1", None),
        "2": ("south", "s2", "customer_arrived_later"),
        "3": (None, "s1", None),
    }
    again = enrich.repair(once, later, "s3", at)
    assert sorted(again.collect()) == sorted(once.collect())


EVENT = (
    "event_id STRING, event_name STRING, event_time TIMESTAMP, scheduled_start_time TIMESTAMP, "
    "appointment_id STRING, booking_journey_id STRING, customer_id STRING, provider_id STRING, "
    "specialty STRING, device_type STRING, session_id STRING"
)
SCHEDULED = "2025-01-02 10:00:00"


def events(spark, rows):
    """rows: (appointment, name, time, session[, customer])."""
    made = [
        (f"e{i}", r[1], r[2], SCHEDULED, r[0], f"j-{r[0]}", r[4] if len(r) > 4 else "c", "p", "s", "d", r[3])
        for i, r in enumerate(rows)
    ]
    text = EVENT.replace("TIMESTAMP", "STRING")
    df = spark.createDataFrame(made, text)
    return df.withColumns(
        {c: F.col(c).cast("timestamp") for c in ("event_time", "scheduled_start_time")}
    )


def test_appointment_outcomes_at_the_deadline(spark):
    rows = [
        ("done", "appointment_booked", "2025-01-01 09:00:00", "s1"),
        ("done", "video_visit_started", "2025-01-02 10:00:00", "s2"),
        ("done", "visit_completed", "2025-01-02 10:30:00", "s2"),
        ("late", "appointment_booked", "2025-01-01 09:00:00", "s1"),
        ("late", "visit_completed", "2025-01-03 10:00:01", "s2"),
        ("orphan", "visit_completed", "2025-01-02 11:00:00", "s2"),
    ]
    df = events(spark, rows)

    def status(as_of):
        fact = facts.appointment_fact(df, F.lit(as_of).cast("timestamp"))
        return {r.appointment_id: r.status for r in fact.collect()}

    # Completed early, but observing until the deadline itself.
    assert status("2025-01-03 09:59:59.999999") == dict.fromkeys(("done", "late", "orphan"), "observing")
    assert status("2025-01-03 10:00:00") == {"done": "completed", "late": "incomplete", "orphan": "completed"}
    fact = facts.appointment_fact(df, F.lit("2025-02-01").cast("timestamp"))
    assert [r.appointment_id for r in fact.where("incomplete_instrumentation").collect()] == ["orphan"]
    assert marts.visit_cohort(fact, []).first().booked == 2


def test_started_completion_counts_a_day_from_the_start(spark):
    rows = [
        ("a", "appointment_booked", "2025-01-01 09:00:00", "s1"),
        ("a", "video_visit_started", "2025-01-02 10:00:00", "s2"),
        ("a", "visit_completed", "2025-01-03 10:00:00", "s2"),
        ("b", "appointment_booked", "2025-01-01 09:00:00", "s1"),
        ("b", "video_visit_started", "2025-01-02 08:00:00", "s2"),
        ("b", "visit_completed", "2025-01-03 09:00:00", "s2"),
    ]
    fact = facts.appointment_fact(events(spark, rows), F.lit("2025-02-01").cast("timestamp"))
    row = marts.visit_cohort(fact, []).first()
    assert (row.mature_completed, row.mature_started, row.mature_started_completed) == (2, 2, 1)


def test_integrity_rules_find_each_kind(spark):
    rows = [
        ("ok", "appointment_booked", "2025-01-01 09:00:00", "s1"),
        ("ok", "visit_completed", "2025-01-02 10:00:00", "s2"),
        ("twice", "visit_completed", "2025-01-02 10:00:00", "s2"),
        ("twice", "visit_completed", "2025-01-02 11:00:00", "s2"),
        ("same", "appointment_booked", "2025-01-01 09:00:00", "s1"),
        ("same", "checkin_started", "2025-01-01 09:30:00", "s1"),
        ("people", "appointment_booked", "2025-01-01 09:00:00", "s1", "c1"),
        ("people", "checkin_started", "2025-01-02 09:30:00", "s2", "c2"),
    ]
    got = {r.rule: r.n for r in facts.integrity_violations(events(spark, rows)).collect() if r.n}
    assert got == {"many_completions": 1, "visit_in_booking_session": 1, "many_customers": 1}


def test_zero_denominator_gives_null(spark):
    funnel = spark.createDataFrame([(0, 0, 0)], "viewed INT, started INT, booked INT")
    rows = marts.step_rates(funnel).collect()
    assert [(r.conversion, r.drop_off) for r in rows] == [(None, None), (None, None)]


def test_conflicts_tell_null_from_empty_text(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("b", "x"), ("b", "x")], "event_id STRING, v STRING")
    assert [r.event_id for r in reconcile.conflicting_payloads(rows, ["v"]).collect()] == ["a"]


def test_replay_partitions_stay_apart(spark, tmp_path):
    path = str(tmp_path / "replay")
    reconcile.write_replay(spark.range(3), path, "r1")
    reconcile.write_replay(spark.range(5), path, "r2")
    reconcile.write_replay(spark.range(4), path, "r1")
    assert reconcile.read_replay(spark, path, "r1").count() == 4
    assert reconcile.read_replay(spark, path, "r2").count() == 5


def test_sequence_follows_the_order_across_partitions(spark):
    rows = spark.range(5000).select((F.xxhash64("id") % 100000).alias("a"), "id").repartition(6)
    got = ordering.with_sequence(rows, ["a", "id"]).orderBy("sequence").collect()
    assert [r.sequence for r in got] == list(range(5000))
    assert [(r.a, r.id) for r in got] == sorted((r.a, r.id) for r in got)
    assert ordering.with_sequence(rows.limit(0), ["a", "id"]).count() == 0


def test_hot_event_id_keeps_its_first_delivery(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.timestamp_seconds(5000 - F.col("id")).alias("ingested_at"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    kept = dedup.first_delivery(rows)
    assert kept.count() == 2001
    assert kept.where("event_id = 'hot'").first().offset == 2997
