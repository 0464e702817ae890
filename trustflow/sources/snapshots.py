"""Snapshot publication: checks first, then a marker that makes the snapshot visible."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustflow.functions.canonical import table_digest
from trustflow.operators import snapshot as ops
from trustflow.sources import store

MARKER_DDL = "snapshot_id STRING, snapshot_at TIMESTAMP, row_count BIGINT"


def data_path(root: str, snapshot_id: str) -> str:
    return f"{root.rstrip('/')}/data/snapshot_id={snapshot_id}"


def marker_path(root: str, snapshot_id: str) -> str:
    return f"{root.rstrip('/')}/published/{snapshot_id}.json"


def rejected_path(root: str, snapshot_id: str) -> str:
    """Errors of a snapshot; an empty table for a published one."""
    return f"{root.rstrip('/')}/rejected/{snapshot_id}"


def publish(
    df: DataFrame,
    root: str,
    snapshot_id: str,
    snapshot_at: str,
    spec: ops.SnapshotSpec,
    expected_count: int | None = None,
    ordered: bool = False,
) -> bool:
    """Stores a complete extract and publishes it when it has no errors.

    ``ordered`` also refuses files whose rows are not in key order. The data is written once and checked from the stored copy. A failed snapshot has no
    marker, so the one before stays active; all its errors are stored under ``rejected``.
    """
    spark = df.sparkSession
    target = data_path(root, snapshot_id)
    df.select(*spec.columns).write.mode("errorifexists").parquet(target)
    stored = spark.read.schema(spec.schema).parquet(target)
    rejected = rejected_path(root, snapshot_id)
    ops.snapshot_errors(stored, spec, expected_count, snapshot_at, ordered).write.mode("errorifexists").parquet(rejected)
    if not spark.read.schema("code STRING").parquet(rejected).isEmpty():
        return False
    marker = {
        "snapshot_id": snapshot_id,
        "snapshot_at": snapshot_at,
        "row_count": stored.count(),
    }
    store.create_text(spark, marker_path(root, snapshot_id), json.dumps(marker, sort_keys=True))
    return True


def published(spark: SparkSession, root: str) -> DataFrame:
    folder = f"{root.rstrip('/')}/published"
    store.make_dirs(spark, folder)
    return spark.read.schema(MARKER_DDL).json(folder)


def active(spark: SparkSession, root: str):
    """Row (snapshot_id, snapshot_at) of the newest published snapshot, or None."""
    row = ops.latest_snapshot(published(spark, root)).first()
    return row if row and row.snapshot_id else None


def read_snapshot(spark: SparkSession, root: str, snapshot_id: str, spec: ops.SnapshotSpec) -> DataFrame:
    return spark.read.schema(spec.schema).parquet(data_path(root, snapshot_id))


def manifest(df: DataFrame, spec: ops.SnapshotSpec, snapshot_id: str, snapshot_at: str) -> dict:
    """Counts, distributions and content digest; a bounded number of rows reaches the driver."""
    counts = ops.profile(df, spec).first().asDict()
    spread: dict[str, dict[str, int]] = {}
    for r in ops.value_distributions(df, list(spec.domains)).orderBy("field", "value").collect():
        spread.setdefault(r.field, {})[r.value] = r.n
    return {
        "snapshot_id": snapshot_id,
        "snapshot_at": snapshot_at,
        "columns": list(spec.columns),
        "digest": table_digest(df, spec.columns).first().digest,
        "distributions": spread,
        **counts,
    }


def with_snapshot(df: DataFrame, snapshot_id: str, snapshot_at: str) -> DataFrame:
    return df.select(
        F.lit(snapshot_id).alias("snapshot_id"),
        F.lit(snapshot_at).cast("timestamp").alias("snapshot_at"),
        *df.columns,
    )
