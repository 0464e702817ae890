"""The durable keyed table, reconciliation into it, and replay promotion."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trustflow.operators import reconcile
from trustflow.sources import keyed, store
from trustflow.streaming import classify, dedup as dedup_stream

START = dt.datetime(2025, 3, 4, tzinfo=dt.timezone.utc)
DDL = "event_id STRING, event_time TIMESTAMP, ingested_at TIMESTAMP, partition INT, offset BIGINT"


def rows(spark, ids, first=0):
    return spark.createDataFrame([(i, START, START, 0, first + n) for n, i in enumerate(ids)], DDL)


def ids_of(table, spark):
    return sorted(r.event_id for r in table.read(spark).collect())


def folders(root):
    return sum(1 for p in root.rglob("*") if p.is_dir())


def test_batches_insert_new_keys_only_and_fold(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path / "t"), buckets=4, fold_after=3)
    assert table.read(spark) is None
    sizes = []
    for n in range(14):
        table.fold(spark, f"b{n:03d}")
        table.merge(rows(spark, [f"e{i}" for i in range(n * 5, n * 5 + 10)], n * 100), f"b{n:03d}")
        sizes.append(folders(tmp_path))
    assert ids_of(table, spark) == sorted(f"e{i}" for i in range(75))
    # Four fixed ones, batches not yet folded or just folded, live and just replaced buckets and their generations.
    assert max(sizes) <= 4 + (2 * table.fold_after + 1) + 4 * table.buckets
    assert table.state(spark)["gen"] >= 3
    first = table.read(spark).where("event_id = 'e7'").first()
    assert (first.merged_by, first.offset) == ("b000", 7)


def test_a_batch_reads_the_buckets_that_it_touches(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path / "t"), buckets=64, fold_after=1)
    table.merge(rows(spark, [f"e{i}" for i in range(2000)]), "b0")
    assert table.fold(spark, "b1")
    one = rows(spark, ["e5"])
    files = table.held(one).inputFiles()
    assert files and len({f.split("bucket=")[1].split("/")[0] for f in files}) == 1
    assert table.held(one).columns == ["event_id"]
    assert table.read(spark).count() == 2000


def test_retries_replace_themselves_and_half_a_fold_is_invisible(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path / "t"), buckets=4, fold_after=1)
    table.merge(rows(spark, ["a", "b"]), "b0")
    table.merge(rows(spark, ["a", "c"]), "b1")
    table.merge(rows(spark, ["a", "c"]), "b1")
    assert ids_of(table, spark) == ["a", "b", "c"]
    table.merge(rows(spark, []), "b1")
    assert ids_of(table, spark) == ["a", "b"]
    # A fold that died before its mark left a generation that nobody reads.
    rows(spark, ["z"]).withColumn("merged_by", F.lit("x")).write.parquet(f"{table.path}/base/gen=1/bucket=0")
    assert ids_of(table, spark) == ["a", "b"]
    assert table.fold(spark) and ids_of(table, spark) == ["a", "b"]
    table.merge(rows(spark, ["a", "b"]), "b0")  # comes again after it was folded
    assert ids_of(table, spark) == ["a", "b"]


def test_empty_retry_clears_a_classified_batch(spark, tmp_path):
    path = str(tmp_path / "c")
    classify.write_batch(rows(spark, ["a", "b"]), path, 0, "app")
    classify.write_batch(rows(spark, ["c"]), path, 1, "app")
    classify.write_batch(rows(spark, []), path, 0, "app")
    assert [(r.event_id, r.batch_id) for r in spark.read.parquet(path).collect()] == [("c", 1)]


def test_stream_merges_into_buckets(spark, tmp_path):
    source = str(tmp_path / "in")
    for n in range(3):
        rows(spark, ["a", f"b{n}"], n * 10).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(source)
    path = str(tmp_path / "t")
    dedup_stream.start_dedup_merge(stream, path, str(tmp_path / "c"), "app", buckets=8).awaitTermination()
    assert ids_of(keyed.KeyedTable(path, buckets=8), spark) == ["a", "b0", "b1", "b2"]


def test_restore_reports_and_refuses_a_second_writer(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path / "t"), buckets=4)
    table.merge(rows(spark, ["a", "b"]), "b0")
    valid = rows(spark, ["a", "b", "c", "c", "d"])
    with keyed.writer_lease(spark, table.path, "other"), pytest.raises(ValueError, match="written by other"):
        keyed.restore(spark, table, valid, "r1")
    assert keyed.restore(spark, table, valid, "r1") == {"expected": 4, "stored_before": 2, "restored": 2, "missing": 0}
    assert keyed.restore(spark, table, valid, "r2") == {"expected": 4, "stored_before": 4, "restored": 0, "missing": 0}
    assert ids_of(table, spark) == ["a", "b", "c", "d"]
    store.create_json(spark, f"{table.path}/_lease.json", {"owner": "restore-r3"})  # r3 died; r3 may go on
    assert keyed.restore(spark, table, valid, "r3")["restored"] == 0


def test_only_an_equal_replay_is_promoted(spark, tmp_path):
    path = str(tmp_path / "replay")
    expected = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "event_id STRING, n INT")
    reconcile.write_replay(expected, path, "good")
    reconcile.write_replay(expected.dropDuplicates(), path, "bad")  # one of two equal rows is gone
    assert reconcile.compare_rows(expected, expected.dropDuplicates()).first()[:] == (3, 2, 1)
    assert reconcile.current_replay(spark, path) is None
    assert reconcile.promote_replay(spark, path, "bad", expected) is False
    assert reconcile.current_replay(spark, path) is None
    assert reconcile.promote_replay(spark, path, "good", expected) and reconcile.promote_replay(spark, path, "good", expected)
    assert reconcile.current_replay(spark, path) == "good"
    assert reconcile.read_replay(spark, path, "good").count() == 3
    again = spark.createDataFrame([("c", 2)], "event_id STRING, n INT")
    reconcile.write_replay(again, path, "later")
    assert reconcile.promote_replay(spark, path, "later", again) and reconcile.current_replay(spark, path) == "later"
