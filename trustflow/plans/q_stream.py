"""Structured Streaming jobs over stored files, run to the end and read back."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from trustflow.functions.times import seconds
from trustflow.operators import classify
from trustflow.operators.bronze import RAW_DDL, raw_deliveries
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.q_snapshot import SPEC
from trustflow.plans.registry import query
from trustflow.session import scratch_dir
from trustflow.sources import kafka, keyed, snapshots
from trustflow.streaming import classify as classify_stream
from trustflow.streaming import dedup as dedup_stream
from trustflow.streaming import ingest

BATCHES = 4
BUCKETS = 16


def ingest_time():
    return F.col("timestamp") + seconds(5)


def topic_files(spark, sf, path, rows=None):
    """Deliveries as files in send order; returns how many files make a quarter of them."""
    files = max(BATCHES, spark.sparkContext.defaultParallelism)
    rows = fx.raw(spark, sf) if rows is None else rows
    rows.repartitionByRange(files, "timestamp").write.mode("append").parquet(path)
    return math.ceil(files / BATCHES)


def topic_in_order(spark, sf, path):
    """Deliveries written slice after slice in send order, so that each slice is one micro-batch and the
    batches come in that order. Returns the files of a slice."""
    rows = fx.raw(spark, sf).withColumn("_sent", F.unix_micros("timestamp"))
    shares = [i / BATCHES for i in range(1, BATCHES)]
    bounds = rows.agg(F.percentile_approx("_sent", shares)).first()[0]
    # A file per task of a micro-batch: every core has one, and a task's rows do not grow with the input. Files are few against
    # the rows of a slice, so that none stays empty and a batch never takes one of the next slice.
    share = rows.count() // BATCHES
    files = max(1, min(fx.tasks_for(rows, share), math.isqrt(share) // 2))
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        inside = F.lit(True) if low is None else F.col("_sent") > low
        if high is not None:
            inside = inside & (F.col("_sent") <= high)
        rows.where(inside).drop("_sent").repartition(files).write.mode("append").parquet(path)
    return files


def run_ingest(spark, source, target, checkpoint, per_trigger=None):
    stream = kafka.delivery_file_stream(spark, source, per_trigger)
    started = ingest.start_ingest(stream, ingest.RawSink(path=target), checkpoint, arrival=ingest_time())
    started.awaitTermination()
    return started


@query(
    "stream_bronze_ingest",
    f"WITH {sql.EV} SELECT concat(topic, ':', part, ':', off) AS raw_record_id, "
    "epoch_us(ingested_at) AS ingested_us, CAST(CASE WHEN wire_kind IN ('tombstone', 'short', "
    "'bad_magic') THEN NULL WHEN wire_kind = 'unknown_schema' THEN 404 WHEN wire_kind = "
    "'other_schema' THEN 2 ELSE 1 END AS BIGINT) AS schema_id FROM ev",
)
def stream_bronze_ingest(spark, sf):
    root = scratch_dir(spark, "ingest")
    per_trigger = topic_files(spark, sf, f"{root}/topic")
    run_ingest(spark, f"{root}/topic", f"{root}/raw", f"{root}/checkpoint", per_trigger)
    return spark.read.parquet(f"{root}/raw").select(
        "raw_record_id", F.unix_micros("ingested_at").alias("ingested_us"), "schema_id"
    )


_COUNTS = "count(*) AS rows, count(DISTINCT raw_record_id) AS keys"


def _key_counts(df):
    per_key = df.groupBy("raw_record_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"))


@query(
    "stream_restart_noop",
    f"WITH {sql.DELIVERIES} SELECT count(*) AS first_run, count(*) AS second_run, "
    "count(DISTINCT raw_record_id) AS keys, true AS same_query, true AS new_run FROM deliveries",
)
def stream_restart_noop(spark, sf):
    """The same checkpoint again without new input adds nothing."""
    root = scratch_dir(spark, "noop")
    topic_files(spark, sf, f"{root}/topic")
    paths = (f"{root}/topic", f"{root}/raw", f"{root}/checkpoint")
    one = run_ingest(spark, *paths)
    before = spark.read.parquet(f"{root}/raw").count()
    two = run_ingest(spark, *paths)
    counts = _key_counts(spark.read.parquet(f"{root}/raw"))
    return counts.select(
        F.lit(before).cast("bigint").alias("first_run"),
        F.col("rows").alias("second_run"),
        "keys",
        F.lit(one.id == two.id).alias("same_query"),
        F.lit(one.runId != two.runId).alias("new_run"),
    )


@query(
    "stream_restart_new_input",
    f"WITH {sql.DELIVERIES} SELECT count(*) FILTER (send_at < TIMESTAMP '2024-01-16 00:00:00') "
    "AS first_run, count(*) AS second_run, count(DISTINCT raw_record_id) AS keys FROM deliveries",
)
def stream_restart_new_input(spark, sf):
    """A restart after more input adds exactly the new rows."""
    root = scratch_dir(spark, "grow")
    rows = fx.raw(spark, sf)
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    paths = (f"{root}/topic", f"{root}/raw", f"{root}/checkpoint")
    topic_files(spark, sf, f"{root}/topic", rows.where(early))
    run_ingest(spark, *paths)
    before = spark.read.parquet(f"{root}/raw").count()
    topic_files(spark, sf, f"{root}/topic", rows.where(~early))
    run_ingest(spark, *paths)
    return _key_counts(spark.read.parquet(f"{root}/raw")).select(
        F.lit(before).cast("bigint").alias("first_run"), F.col("rows").alias("second_run"), "keys"
    )


@query(
    "stream_classify",
    f"WITH {sql.DELIVERIES} SELECT raw_record_id, route, codes FROM deliveries",
)
def stream_classify(spark, sf):
    root = scratch_dir(spark, "classify")
    per_trigger = topic_files(spark, sf, f"{root}/topic")
    run_ingest(spark, f"{root}/topic", f"{root}/raw", f"{root}/checkpoint-raw", per_trigger)
    stream = spark.readStream.schema(RAW_DDL).parquet(f"{root}/raw")
    # The second start finds nothing new, so it must not add rows.
    for _ in range(2):
        classify_stream.start_classify(
            stream, f"{root}/classified", f"{root}/checkpoint", "routes-v1", fx.schema_lookup, fx.CONTRACT
        ).awaitTermination()
    return spark.read.parquet(f"{root}/classified").select(
        "raw_record_id", "route", F.array_join("error_codes", ",").alias("codes")
    )


def valid_stream(spark, topic, per_trigger=None):
    """Future-dated and broken events leave before the watermark sees them."""
    raw = raw_deliveries(kafka.delivery_file_stream(spark, topic, per_trigger), ingest_time())
    routed = classify.classify(raw, fx.catalog(spark), fx.CONTRACT)
    return classify.valid_view(routed, fx.CONTRACT).drop("processed_at")


@query("stream_dedup", f"WITH {sql.UNIQUE} SELECT event_id, event_name FROM uniq")
def stream_dedup(spark, sf):
    """One micro-batch, so no row can be late: exactly the unique events remain."""
    root = scratch_dir(spark, "dedup")
    topic_files(spark, sf, f"{root}/topic")
    writer = dedup_stream.deduplicated(valid_stream(spark, f"{root}/topic")).writeStream
    writer = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    with ingest.state_partitions(spark, spark.sparkContext.defaultParallelism):
        started = writer.format("parquet").start(f"{root}/events")
    started.awaitTermination()
    return spark.read.parquet(f"{root}/events").select("event_id", "event_name")


def _merged(spark, sf, root):
    per_trigger = topic_in_order(spark, sf, f"{root}/topic")
    stream = valid_stream(spark, f"{root}/topic", per_trigger)
    started = dedup_stream.start_dedup_merge(
        stream,
        f"{root}/events",
        f"{root}/checkpoint",
        "events-v1",
        partitions=spark.sparkContext.defaultParallelism,
        buckets=BUCKETS,
    )
    started.awaitTermination()
    return keyed.KeyedTable(f"{root}/events", buckets=BUCKETS)


# A row that was sent within the lateness of its event cannot be late in any batching: batches
# follow the send order, and no event before it can carry a later time than its own sending.
_PUNCTUAL = "count(*) FILTER (epoch_us(send_at) - epoch_us(event_time) <= 1800000000) AS punctual_stored"


def _punctual(spark, sf):
    sent = F.unix_micros("ingested_at") - 5_000_000
    return fx.unique_events(spark, sf).where(sent - F.unix_micros("event_time") <= 1_800_000_000)


@query(
    "stream_dedup_merge",
    f"WITH {sql.UNIQUE} SELECT event_name, {_PUNCTUAL}, 0::BIGINT AS repeated_ids, 0::BIGINT AS unknown_ids "
    "FROM uniq GROUP BY event_name",
)
def stream_dedup_merge(spark, sf):
    """Several micro-batches: every event that cannot be late is stored, no id repeats, none is foreign."""
    durable = _merged(spark, sf, scratch_dir(spark, "merge")).read(spark)
    have = durable.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_name").alias("stored_as"))
    want = fx.unique_events(spark, sf).select("event_id", "event_name")
    punctual = _punctual(spark, sf).select("event_id", F.lit(True).alias("in_time"))
    both = want.join(punctual, "event_id", "left").join(have, "event_id", "full_outer")
    return both.groupBy(F.coalesce("event_name", "stored_as").alias("event_name")).agg(
        F.count_if(F.col("in_time") & F.col("n").isNotNull()).alias("punctual_stored"),
        F.count_if(F.col("n") > 1).alias("repeated_ids"),
        F.count_if(both["event_name"].isNull()).alias("unknown_ids"),
    )


@query(
    "late_recovery",
    f"WITH {sql.UNIQUE} SELECT event_name, count(*) AS events, {_PUNCTUAL}, 0::BIGINT AS in_both "
    "FROM uniq GROUP BY event_name",
)
def late_recovery(spark, sf):
    """What the watermark dropped comes back by reconciliation with the stored valid deliveries; what it
    did not drop was stored before."""
    table = _merged(spark, sf, scratch_dir(spark, "late"))
    # Twice: the second run finds nothing to restore.
    for run in ("r1", "r2"):
        keyed.restore(spark, table, fx.kept_valid(spark, sf).drop("processed_at"), run)
    restored = F.col("merged_by").startswith("restore-")
    sides = table.read(spark).select("event_id", "event_name", F.when(restored, 0).otherwise(1).alias("stored"))
    per_id = sides.groupBy("event_id", "event_name").agg(F.max("stored").alias("stored"), F.count(F.lit(1)).alias("n"))
    punctual = _punctual(spark, sf).select("event_id", F.lit(True).alias("in_time"))
    return per_id.join(punctual, "event_id", "left").groupBy("event_name").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("in_time") & (F.col("stored") == 1)).alias("punctual_stored"),
        F.count_if(F.col("n") > 1).alias("in_both"),
    )


_STATUS = (
    "CASE WHEN e.customer_id IS NULL THEN 'anonymous' WHEN c.customer_id IS NULL "
    "THEN 'customer_not_found' ELSE 'matched' END"
)


@query(
    "stream_enrich",
    f"WITH {sql.UNIQUE}, {sql.SNAPSHOTS} SELECT event_id, {_STATUS} AS customer_match_status, "
    "c.membership_plan, 'v2' AS customer_snapshot_id FROM uniq e LEFT JOIN v2 c "
    "ON e.customer_id = c.customer_id",
)
def stream_enrich(spark, sf):
    """Every micro-batch joins to the newest published snapshot."""
    root = scratch_dir(spark, "enrich")
    shop = f"{root}/snapshots"
    snapshots.publish(fx.snapshot_v1(spark, sf), shop, "v1", "2024-01-01 00:00:00", SPEC)
    snapshots.publish(fx.snapshot_v2(spark, sf), shop, "v2", "2024-01-02 00:00:00", SPEC)
    path = fx.unique_path(spark, sf)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    dedup_stream.start_enrich(
        stream, f"{root}/enriched", f"{root}/checkpoint", "enrich-v1", shop, SPEC
    ).awaitTermination()
    return spark.read.parquet(f"{root}/enriched").select(
        "event_id", "customer_match_status", "membership_plan", "customer_snapshot_id"
    )
