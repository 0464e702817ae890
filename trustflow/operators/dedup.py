"""Event-id deduplication in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL_ORDER = ("ingested_at", "partition", "offset")


def first_delivery(valid: DataFrame, key: str = "event_id", order=ARRIVAL_ORDER) -> DataFrame:
    """The first delivery of every event id.

    ``row_number() = 1`` becomes a group limit that runs before the shuffle, so each map
    task sends at most one row per id and a hot id cannot fill one task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return valid.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def repeats(deliveries: DataFrame, key: str = "event_id") -> DataFrame:
    """Total deliveries and how many repeat an id already seen; counts combine map-side."""
    per_id = deliveries.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("deliveries"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def key_groups(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def insert_only(
    target_ids: DataFrame,
    batch: DataFrame,
    key: str = "event_id",
    order=ARRIVAL_ORDER,
) -> DataFrame:
    """Rows of a batch whose key the target does not hold yet, one per key.

    The target is read for its key column only and first cut down to the keys of the batch, so the
    smaller side is the one to broadcast or shuffle; the batch is read twice for that.
    """
    held = target_ids.select(key).join(batch.select(key).distinct(), key, "left_semi").distinct()
    return first_delivery(batch, key, order).join(held, key, "left_anti")
