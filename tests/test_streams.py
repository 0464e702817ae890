"""Restart, late data, bindings, progress and table targets of the streaming jobs."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from wire_helper import CONTRACT, booking, frame

from trustflow.operators import dedup, health, reconcile
from trustflow.operators.bronze import RAW_DDL
from trustflow.plans.q_snapshot import SPEC
from trustflow.sources import kafka, store
from trustflow.streaming import binding, classify, dedup as dedup_stream, ingest, progress

START = dt.datetime(2025, 3, 4, 12, 0, tzinfo=dt.timezone.utc)


def put_file(spark, folder, rows, ddl=kafka.KAFKA_DDL):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder))


def delivery(offset, value=b"x"):
    return ("events", 0, offset, None, value, [("h", b"1")], START, 0)


VALID_DDL = (
    "event_id STRING, event_time TIMESTAMP, raw_record_id STRING, ingested_at TIMESTAMP, "
    "partition INT, offset BIGINT"
)


def waited(spark, log):
    """Progress reports reach listeners a little later than the query ends."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    seen = -1
    while seen != log.count:
        seen = log.count
        time.sleep(0.5)
    spark.streams.removeListener(log)


def valid_row(event_id, minutes, offset):
    return (event_id, START + dt.timedelta(minutes=minutes), f"t:0:{offset}", START, 0, offset)


def valid_stream(spark, folder):
    return (
        spark.readStream.schema(VALID_DDL).option("maxFilesPerTrigger", 1).parquet(str(folder))
    )


def test_ingest_into_a_table_and_restart(spark, tmp_path):
    table = "raw_deliveries_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    topic, checkpoint = tmp_path / "topic", str(tmp_path / "checkpoint")
    put_file(spark, topic, [delivery(0), delivery(1, None)])

    ops = str(tmp_path / "ops")
    log = progress.start_log(spark, ops)

    def run():
        stream = kafka.delivery_file_stream(spark, str(topic), 1)
        query = ingest.start_ingest(stream, ingest.RawSink(table=table), checkpoint)
        query.awaitTermination()
        return query

    a = run()
    assert spark.table(table).count() == 2
    b = run()
    assert spark.table(table).count() == 2
    put_file(spark, topic, [delivery(2)])
    c = run()
    rows = spark.table(table).orderBy("offset").collect()
    assert [r.raw_record_id for r in rows] == ["events:0:0", "events:0:1", "events:0:2"]
    assert rows[1].value is None and rows[0].headers[0].key == "h"
    assert a.id == b.id == c.id and len({a.runId, b.runId, c.runId}) == 3
    waited(spark, log)
    report = progress.progress_rows(spark, ops).where(F.col("run_id") == c.runId).orderBy("batch_id").collect()
    assert sum(r.input_rows for r in report) == 1
    assert report[0].start_offset != report[0].end_offset


def test_ingest_refuses_another_kind_of_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS other_raw")
    spark.sql("CREATE TABLE other_raw (id BIGINT) USING parquet")
    with pytest.raises(ValueError, match="columns of raw"):
        ingest.RawSink(table="other_raw").prepare(spark)
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="columns of raw"):
        ingest.RawSink(path=str(tmp_path / "other")).prepare(spark)
    with pytest.raises(ValueError, match="cannot enforce"):
        ingest.RawSink(table="other_raw", enforced=True).prepare(spark)
    with pytest.raises(ValueError, match="either"):
        ingest.RawSink().prepare(spark)


def test_rate_limit_makes_one_batch_per_file(spark, tmp_path):
    for i in range(3):
        put_file(spark, tmp_path / "topic", [delivery(i)])
    stream = kafka.delivery_file_stream(spark, str(tmp_path / "topic"), 1)
    log = progress.start_log(spark, str(tmp_path / "ops"))
    query = ingest.start_ingest(stream, ingest.RawSink(path=str(tmp_path / "raw")), str(tmp_path / "c"))
    query.awaitTermination()
    waited(spark, log)
    sizes = [r.input_rows for r in progress.progress_rows(spark, str(tmp_path / "ops")).collect() if r.input_rows]
    assert sizes == [1, 1, 1]


def test_trigger_modes():
    with pytest.raises(ValueError):
        ingest.paced(None, "once")


def test_progress_of_a_long_run_is_whole(spark, tmp_path):
    for i in range(112):
        put_file(spark, tmp_path / "topic", [delivery(i)])
    log = progress.start_log(spark, str(tmp_path / "ops"))
    stream = kafka.delivery_file_stream(spark, str(tmp_path / "topic"), 1)
    query = ingest.start_ingest(stream, ingest.RawSink(path=str(tmp_path / "raw")), str(tmp_path / "c"))
    query.awaitTermination()
    waited(spark, log)
    assert len(query.recentProgress) <= 100
    rows = progress.progress_rows(spark, str(tmp_path / "ops")).where("input_rows > 0")
    assert rows.agg(F.sum("input_rows"), F.countDistinct("batch_id")).first()[:] == (112, 112)


def test_retried_classify_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "classified")
    values = [frame(booking()), b"", None]
    rows = [("events", 0, i, None, v, None, START, 0) for i, v in enumerate(values)]
    from trustflow.operators.bronze import raw_deliveries

    batch = raw_deliveries(spark.createDataFrame(rows, kafka.KAFKA_DDL))
    handle = classify.batch_handler(path, "app", {1: CONTRACT.schema_json}.get, CONTRACT)
    handle(batch, 0)
    handle(batch, 0)
    stored = spark.read.parquet(path)
    assert stored.count() == 3
    assert sorted(r.route for r in stored.collect()) == ["quarantine", "quarantine", "valid"]
    with pytest.raises(ValueError):
        classify.start_classify(batch, path, path, "app", None, CONTRACT)


def test_late_rows_drop_after_the_gap_batch_and_come_back(spark, tmp_path):
    source = tmp_path / "valid"
    # The watermark of one batch filters the next, so the late row comes two files later.
    put_file(spark, source, [valid_row("a", 0, 0), valid_row("a", 0, 1)], VALID_DDL)
    put_file(spark, source, [valid_row("b", 120, 2)], VALID_DDL)
    put_file(spark, source, [valid_row("c", 121, 3)], VALID_DDL)
    put_file(spark, source, [valid_row("late", 10, 4), valid_row("intime", 100, 5)], VALID_DDL)
    path = str(tmp_path / "events")
    log = progress.start_log(spark, str(tmp_path / "ops"))
    query = dedup_stream.start_dedup_merge(
        valid_stream(spark, source), path, str(tmp_path / "c"), "app"
    )
    query.awaitTermination()
    durable = spark.read.parquet(path)
    assert sorted(r.event_id for r in durable.collect()) == ["a", "b", "c", "intime"]
    waited(spark, log)
    dropped = progress.dropped_by_watermark(spark, str(tmp_path / "ops")).first()
    assert (dropped.query_id, dropped.dropped_by_watermark) == (query.id, 1)
    valid = spark.read.schema(VALID_DDL).parquet(str(source))
    lost = dedup.first_delivery(reconcile.missing_events(valid, durable)).collect()
    assert [r.event_id for r in lost] == ["late"]


def test_merge_protects_beyond_the_state_window(spark, tmp_path):
    source = tmp_path / "valid"
    put_file(spark, source, [valid_row("a", 0, 0)], VALID_DDL)
    for i, minutes in enumerate((200, 400, 401)):
        put_file(spark, source, [valid_row(f"x{i}", minutes, i + 1)], VALID_DDL)
    # Same id with a newer event time, long after its state is gone.
    put_file(spark, source, [valid_row("a", 402, 9)], VALID_DDL)
    plain = tmp_path / "plain"
    writer = dedup_stream.deduplicated(valid_stream(spark, source)).writeStream
    writer.option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).format(
        "parquet"
    ).start(str(plain)).awaitTermination()
    assert spark.read.parquet(str(plain)).where("event_id = 'a'").count() == 2
    merged = str(tmp_path / "merged")
    dedup_stream.start_dedup_merge(
        valid_stream(spark, source), merged, str(tmp_path / "c2"), "app"
    ).awaitTermination()
    stored = spark.read.parquet(merged).where("event_id = 'a'").collect()
    assert [r.offset for r in stored] == [0]


def test_retried_merge_batch_does_not_lose_its_rows(spark, tmp_path):
    path = str(tmp_path / "events")
    batch = spark.createDataFrame([valid_row("a", 0, 0), valid_row("a", 0, 1)], VALID_DDL)
    handle = dedup_stream.merge_handler(path, "app")
    handle(batch, 0)
    handle(batch, 0)
    handle(batch, 1)
    assert [r.offset for r in spark.read.parquet(path).collect()] == [0]


def test_enrichment_waits_for_a_snapshot(spark, tmp_path):
    handle = dedup_stream.enrich_handler(str(tmp_path / "e"), "app", str(tmp_path / "shop"), SPEC)
    with pytest.raises(ValueError, match="No published snapshot"):
        handle(spark.createDataFrame([valid_row("a", 0, 0)], VALID_DDL), 0)


def test_checkpoint_claims(spark, tmp_path):
    registry, checkpoint = str(tmp_path / "registry"), str(tmp_path / "c")
    mine = binding.Claim("routes", "raw", "classified", "1.0.0")
    assert binding.claim(spark, registry, checkpoint, mine) is True
    store.make_dirs(spark, checkpoint + "/offsets")
    assert binding.claim(spark, registry, checkpoint + "/", mine) is False
    with pytest.raises(ValueError, match="rules '1.0.0' is not '1.1.0'"):
        binding.claim(spark, registry, checkpoint, binding.Claim("routes", "raw", "classified", "1.1.0"))
    store.make_dirs(spark, str(tmp_path / "old" / "offsets"))
    with pytest.raises(ValueError, match="nobody claimed"):
        binding.claim(spark, registry, str(tmp_path / "old"), mine)


def test_streams_claim_their_checkpoints_and_keep_views(spark, tmp_path):
    registry, topic = str(tmp_path / "registry"), tmp_path / "topic"
    put_file(spark, topic, [delivery(0)])
    raw = kafka.delivery_file_stream(spark, str(topic))
    sink = ingest.RawSink(path=str(tmp_path / "raw"))
    ingest.start_ingest(raw, sink, str(tmp_path / "c"), registry=registry, source="a").awaitTermination()
    with pytest.raises(ValueError, match="source 'a' is not 'b'"):
        ingest.start_ingest(raw, sink, str(tmp_path / "c"), registry=registry, source="b")
    stored = spark.readStream.schema(RAW_DDL).parquet(str(tmp_path / "raw"))
    lookup = {1: CONTRACT.schema_json}.get
    path = str(tmp_path / "classified")
    classify.start_classify(
        stored, path, str(tmp_path / "k"), "app", lookup, CONTRACT, views="kept_", registry=registry
    ).awaitTermination()
    assert spark.table("kept_validated_deliveries").count() + spark.table("kept_quarantine_events").count() == 1


def test_recovery_time(spark):
    rows = [("i1", "failed", START), ("i1", "caught_up", START + dt.timedelta(seconds=95))]
    runs = spark.createDataFrame(rows, "incident STRING, state STRING, at TIMESTAMP")
    assert health.recovery_seconds(runs).first().recovery_seconds == 95.0


def test_latency_sketch_matches_exact_on_small_data(spark):
    rows = spark.range(1, 1001).select(
        F.timestamp_seconds("id").alias("later"), F.timestamp_seconds(F.lit(0)).alias("earlier")
    )
    exact = health.latency_profile(rows, "later", "earlier").first()
    rough = health.latency_profile(rows, "later", "earlier", exact=False).first()
    assert abs(exact.p95 - rough.p95) <= 1 and exact.max == rough.max == 1000.0


def test_exact_percentiles_over_many_partitions(spark):
    """Heavy ties, negatives and an even count against a direct computation."""
    values = [(i * 37) % 101 if i % 3 else 7 for i in range(1000)] + [-5, -1]
    rows = spark.createDataFrame([(v,) for v in values], "s BIGINT").select(
        F.timestamp_seconds(F.col("s") + 1000).alias("later"),
        F.timestamp_seconds(F.lit(1000)).alias("earlier"),
    )
    got = health.latency_profile(rows.repartition(7), "later", "earlier").first()
    good = sorted(v for v in values if v >= 0)

    def cont(p):
        rank = p * (len(good) - 1)
        low = int(rank)
        return good[low] + (good[min(low + 1, len(good) - 1)] - good[low]) * (rank - low)

    assert (got.measured, got.negative, got.max) == (len(good), 2, max(good))
    assert got.p50 == pytest.approx(cont(0.5)) and got.p95 == pytest.approx(cont(0.95))
    empty = health.latency_profile(rows.limit(0), "later", "earlier").first()
    assert (empty.measured, empty.p50, empty.max) == (0, None, None)


def test_slices_have_a_file_for_every_core_and_stay_in_order(spark, sf_dir, tmp_path):
    from trustflow.plans import q_stream

    files = q_stream.topic_in_order(spark, sf_dir, str(tmp_path / "topic"))
    assert files >= spark.sparkContext.defaultParallelism
    written = sorted((tmp_path / "topic").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    assert len(written) == q_stream.BATCHES * files
    spans = []
    for i in range(0, len(written), files):
        sent = spark.read.parquet(*map(str, written[i : i + files])).selectExpr("min(timestamp) AS low", "max(timestamp) AS high")
        spans.append(tuple(sent.first()))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
