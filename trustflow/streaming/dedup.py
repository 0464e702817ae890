"""Watermarked deduplication, durable insert-only merge and per-batch enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trustflow.operators import dedup as ops
from trustflow.operators.enrich import enrich
from trustflow.operators.snapshot import SnapshotSpec
from trustflow.sources import snapshots, store
from trustflow.sources.keyed import KeyedTable
from trustflow.streaming import binding
from trustflow.streaming.classify import write_batch
from trustflow.streaming.ingest import paced, state_partitions

LATENESS = "30 minutes"


def deduplicated(valid_stream: DataFrame, lateness: str = LATENESS, key: str = "event_id") -> DataFrame:
    """First delivery of each id inside the watermark; state older than it is dropped.

    The input must hold valid rows only: a future-dated event would push the watermark.
    """
    return valid_stream.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark([key])


def merge_handler(path: str, app_id: str, key: str = "event_id", fmt: str = "parquet", buckets: int | None = None):
    """Insert-only merge of a micro-batch into the durable unique-event table.

    With ``buckets`` the table is a ``KeyedTable``: a batch reads the buckets that it touches. Without, batches
    are folders of one Parquet table and each batch reads the key column of all.
    """
    table = KeyedTable(path, key, buckets) if buckets else None

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if fmt == "delta":
            from delta.tables import DeltaTable

            target = DeltaTable.forPath(spark, path)
            (
                target.alias("t")
                .merge(ops.first_delivery(batch, key).alias("s"), f"t.{key} = s.{key}")
                .whenNotMatchedInsertAll()
                .execute()
            )
            return
        if table is not None:
            label = f"{app_id}-{batch_id:012d}"
            table.fold(spark, label)
            batch.persist()  # looked at three times; the stateful plan must run once
            try:
                table.merge(batch, label)
            finally:
                batch.unpersist()
            return
        store.make_dirs(spark, path)
        held = spark.read.schema(f"{key} STRING, batch_id BIGINT").parquet(path)
        # A retried batch must not see its own earlier write as already present.
        prior = held.where(F.col("batch_id") != batch_id)
        # The merge looks at the batch twice; without this the stateful plan would run twice.
        batch.persist()
        try:
            new = ops.insert_only(prior, batch, key)
            write_batch(new, path, batch_id, app_id, fmt)
        finally:
            batch.unpersist()

    return process


def start_dedup_merge(
    valid_stream: DataFrame,
    path: str,
    checkpoint: str,
    app_id: str,
    lateness: str = LATENESS,
    cadence: str = "drain",
    fmt: str = "parquet",
    partitions: int | None = None,
    registry: str | None = None,
    source: str = "",
    buckets: int | None = None,
) -> StreamingQuery:
    if registry:
        binding.claim(valid_stream.sparkSession, registry, checkpoint, binding.Claim(app_id, source, path))
    writer = (
        deduplicated(valid_stream, lateness)
        .writeStream.option("checkpointLocation", checkpoint)
        .queryName("dedup_" + app_id)
        .foreachBatch(merge_handler(path, app_id, fmt=fmt, buckets=buckets))
    )
    with state_partitions(valid_stream.sparkSession, partitions):
        return paced(writer, cadence).start()


def enrich_handler(path: str, app_id: str, snapshot_root: str, spec: SnapshotSpec, fmt: str = "parquet"):
    """Chooses one published snapshot per micro-batch and joins the whole batch to it."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        chosen = snapshots.active(spark, snapshot_root)
        if chosen is None:
            raise ValueError("No published snapshot yet; the batch must retry")
        dim = snapshots.read_snapshot(spark, snapshot_root, chosen.snapshot_id, spec)
        write_batch(enrich(batch, dim, chosen.snapshot_id), path, batch_id, app_id, fmt)

    return process


def start_enrich(
    events_stream: DataFrame,
    path: str,
    checkpoint: str,
    app_id: str,
    snapshot_root: str,
    spec: SnapshotSpec,
    cadence: str = "drain",
    registry: str | None = None,
    source: str = "",
) -> StreamingQuery:
    if registry:
        binding.claim(events_stream.sparkSession, registry, checkpoint, binding.Claim(app_id, source, path))
    writer = (
        events_stream.writeStream.option("checkpointLocation", checkpoint)
        .queryName("enrich_" + app_id)
        .foreachBatch(enrich_handler(path, app_id, snapshot_root, spec))
    )
    return paced(writer, cadence).start()
