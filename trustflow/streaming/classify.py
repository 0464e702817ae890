"""Classification stream: both routes of a micro-batch are one idempotent write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trustflow.contract import Contract
from trustflow.operators import classify as ops
from trustflow.streaming import binding
from trustflow.streaming.ingest import paced


def write_batch(df: DataFrame, path: str, batch_id: int, app_id: str, fmt: str = "parquet") -> None:
    """Writes one batch so that a retried batch replaces itself.

    Delta keeps (app id, batch id) in its log; for parquet the batch is its own folder, which a retry overwrites
    even with nothing.
    """
    if fmt == "delta":
        (
            df.write.format("delta")
            .mode("append")
            .option("txnAppId", app_id)
            .option("txnVersion", batch_id)
            .save(path)
        )
        return
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def batch_handler(
    path: str,
    app_id: str,
    lookup: Callable[[int], str | None],
    contract: Contract,
    processed_at: Column | None = None,
    fmt: str = "parquet",
    views: str | None = None,
):
    """``views`` is a prefix for the valid and quarantine views, kept current by every batch.

    The source of a batch is read once; twice only where it names a schema for the first time.
    """
    schemas = ops.SchemaCache(lookup)

    def process(batch: DataFrame, batch_id: int) -> None:
        schemas.run(
            batch,
            lambda catalog: write_batch(
                ops.classify(batch, catalog, contract, processed_at), path, batch_id, app_id, fmt
            ),
        )
        if views is not None:
            ops.register_views(f"{fmt}.`{path}`", batch.sparkSession, contract, views)

    return process


def start_classify(
    raw_stream: DataFrame,
    path: str,
    checkpoint: str,
    app_id: str,
    lookup: Callable[[int], str | None],
    contract: Contract,
    processed_at: Column | None = None,
    cadence: str = "drain",
    fmt: str = "parquet",
    views: str | None = None,
    registry: str | None = None,
    source: str = "",
) -> StreamingQuery:
    if not checkpoint or not app_id or checkpoint.rstrip("/") == path.rstrip("/"):
        raise ValueError("A separate checkpoint and a stable app id are required")
    if registry:
        binding.claim(
            raw_stream.sparkSession, registry, checkpoint, binding.Claim(app_id, source, path, contract.rule_version)
        )
    writer = (
        raw_stream.writeStream.option("checkpointLocation", checkpoint)
        .queryName("classify_" + app_id)
        .foreachBatch(batch_handler(path, app_id, lookup, contract, processed_at, fmt, views))
    )
    return paced(writer, cadence).start()
