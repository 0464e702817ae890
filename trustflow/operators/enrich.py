"""Customer context on events, as observed at processing time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHED, ANONYMOUS, NOT_FOUND = "matched", "anonymous", "customer_not_found"
ATTRIBUTES = ("region", "membership_plan", "acquisition_channel", "account_status")


def _spread_key(wanted: Column, key: str, row_id: str) -> Column:
    """The lookup key, or a key that matches nothing and differs per row.

    Rows without a customer would all hash to one task if the join has to shuffle.
    """
    return F.when(wanted, F.col(key)).otherwise(
        F.concat(F.lit("\x00"), F.xxhash64(row_id).cast("string"))
    )


def _lookup(dim: DataFrame, key: str, attributes) -> DataFrame:
    return dim.select(
        F.col(key).alias("_dim_key"), F.struct(*attributes).alias("_dim")
    )


def enrich(
    events: DataFrame,
    dim: DataFrame,
    snapshot_id: str,
    key: str = "customer_id",
    row_id: str = "event_id",
    attributes=ATTRIBUTES,
) -> DataFrame:
    """Left join to one published snapshot; every event row comes out once.

    The dimension is unique by key. Catalyst broadcasts it while its size allows and
    shuffles it otherwise; skewed keys are then split at run time.
    """
    known = F.coalesce(F.col(key), F.lit("")) != ""
    joined = events.withColumn("_join_key", _spread_key(known, key, row_id)).join(
        _lookup(dim, key, attributes), F.col("_join_key") == F.col("_dim_key"), "left"
    )
    status = (
        F.when(~known, ANONYMOUS).when(F.col("_dim_key").isNull(), NOT_FOUND).otherwise(MATCHED)
    )
    return joined.select(
        *events.columns,
        *[F.col(f"_dim.{a}").alias(a) for a in attributes],
        F.lit(snapshot_id).alias("customer_snapshot_id"),
        status.alias("customer_match_status"),
        F.lit(None).cast("timestamp").alias("repaired_at"),
        F.lit(None).cast("string").alias("repair_reason"),
    )


def repair(
    enriched: DataFrame,
    dim: DataFrame,
    snapshot_id: str,
    repaired_at: Column,
    reason: str = "customer_arrived_later",
    key: str = "customer_id",
    row_id: str = "event_id",
    attributes=ATTRIBUTES,
) -> DataFrame:
    """Fills rows that had no customer when a later snapshot has one; others stay as they are."""
    open_row = F.col("customer_match_status") == NOT_FOUND
    joined = enriched.withColumn("_join_key", _spread_key(open_row, key, row_id)).join(
        _lookup(dim, key, attributes), F.col("_join_key") == F.col("_dim_key"), "left"
    )
    fixed = open_row & F.col("_dim_key").isNotNull()
    new = {a: F.col(f"_dim.{a}") for a in attributes}
    new |= {
        "customer_snapshot_id": F.lit(snapshot_id),
        "customer_match_status": F.lit(MATCHED),
        "repaired_at": repaired_at,
        "repair_reason": F.lit(reason),
    }
    return joined.select(
        *[
            F.when(fixed, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in enriched.columns
        ]
    )


def not_found_rate(enriched: DataFrame) -> DataFrame:
    known = F.col("customer_match_status") != ANONYMOUS
    counts = enriched.agg(
        F.count_if(F.col("customer_match_status") == NOT_FOUND).alias("not_found"),
        F.count_if(known).alias("with_customer"),
    )
    return counts.withColumn("rate", F.try_divide("not_found", "with_customer"))
