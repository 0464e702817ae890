"""Global sequence numbers and exact quantiles without a single-task sort or window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustflow.session import ensure_checkpoint_dir, materialize

PARTITION_BITS = 33


def with_sequence(df: DataFrame, order, name: str = "sequence") -> DataFrame:
    """0-based position in the total order.

    A range-partitioned sort is written to the checkpoint folder, which fixes the rows of
    every partition. Only one row count per partition is then summed up to turn local
    positions into global ones.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.orderBy(*order).checkpoint()
    local = stored.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", PARTITION_BITS)
    sizes = local.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_id") - F.shiftleft(part, PARTITION_BITS)
    # One row per partition, so the broadcast side is bounded by the partition count.
    return (
        local.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within)
        .drop("_id", "_part", "_start")
    )


def cumulative_counts(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with the ranks they cover: columns <column>, n, below, parts' totals.

    Values are counted first, so a value that a third of all rows share is one row. The
    sorted counts are stored with their range partition; running sums stay inside a
    partition and start from the sums of the partitions before it.
    """
    counts = values.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    stored = materialize(
        counts.orderBy(column).withColumn("_part", F.spark_partition_id()), "sorted-counts"
    )
    sums = stored.groupBy("_part").agg(
        F.sum("n").alias("_n"), F.sum(F.when(F.col(column) < 0, F.col("n")).otherwise(0)).alias("_neg")
    )
    everything = Window.partitionBy()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the window and the broadcast are bounded by the partition count.
    starts = sums.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_n").over(everything).alias("total"),
        F.sum("_neg").over(everything).alias("negative"),
    )
    inside = Window.partitionBy("_part").orderBy(column)
    running = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        stored.join(F.broadcast(starts), "_part")
        .withColumn("below", F.col("_start") + running - F.col("n"))
        .drop("_part", "_start")
    )
