"""Pipeline health over closed ranges. The rates overlap and need not add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustflow.functions.times import seconds_between
from trustflow.operators.ordering import cumulative_counts

WINDOW = "5 minutes"
PERCENTILES = {"p50": 0.5, "p95": 0.95}


def closed_windows(df: DataFrame, as_of: Column, at: str = "ingested_at", size: str = WINDOW) -> DataFrame:
    """Adds the window start; rows of windows still open at the boundary are left out.

    The boundary holds for the time itself too, which reaches the scan, and for the partitions of a
    table by ``ingest_date``.
    """
    df = df.where(F.col(at) < as_of)
    if at == "ingested_at" and "ingest_date" in df.columns:
        df = df.where(F.col("ingest_date") <= F.to_date(as_of))
    w = F.window(at, size)
    return df.withColumn("_w", w).where(F.col("_w.end") <= as_of).select(
        *df.columns, F.col("_w.start").alias("window_start")
    )


def throughput(deliveries: DataFrame, as_of: Column) -> DataFrame:
    return (
        closed_windows(deliveries, as_of)
        .groupBy("window_start")
        .agg(F.count(F.lit(1)).alias("deliveries"))
    )


def latency_profile(df: DataFrame, later: str, earlier: str, exact: bool = True) -> DataFrame:
    """Percentiles of the latency in seconds; negative values are counted apart.

    The exact form reads them off sorted value counts that stay distributed. ``exact=False``
    keeps a fixed-size sketch in one pass instead.
    """
    micros = (F.unix_micros(later) - F.unix_micros(earlier)).alias("v")
    lags = df.select(micros).where("v IS NOT NULL")
    usable = F.when(F.col("v") >= 0, F.col("v"))
    if not exact:
        return lags.agg(
            F.count(usable).alias("measured"),
            F.count_if(F.col("v") < 0).alias("negative"),
            *[(F.percentile_approx(usable, p, 100000) / 1e6).alias(n) for n, p in PERCENTILES.items()],
            (F.max(usable) / 1e6).alias("max"),
        )
    ranked = cumulative_counts(lags, "v")
    measured = F.col("total") - F.col("negative")

    def value_at(index: Column) -> Column:
        covered = (F.col("below") <= index) & (index < F.col("below") + F.col("n"))
        return F.max(F.when(covered, F.col("v")))

    picks = []
    for name, p in PERCENTILES.items():
        rank = F.col("negative") + p * (measured - 1)
        picks += [
            value_at(F.floor(rank)).alias(f"{name}_lo"),
            value_at(F.ceil(rank)).alias(f"{name}_hi"),
            F.max(rank - F.floor(rank)).alias(f"{name}_part"),
        ]
    found = ranked.agg(
        F.coalesce(F.max(measured), F.lit(0)).alias("measured"),
        F.coalesce(F.max("negative"), F.lit(0)).alias("negative"),
        *picks,
        (F.max(usable) / 1e6).alias("max"),
    )

    def between(name: str) -> Column:
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return ((low + (high - low) * F.col(f"{name}_part")) / 1e6).alias(name)

    some = F.col("measured") > 0
    return found.select(
        "measured", "negative", *[F.when(some, between(n)).alias(n) for n in PERCENTILES], "max"
    )


SKETCH_BITS = 7


def latency_sketch(df: DataFrame, later: str, earlier: str, by=(), bits: int = SKETCH_BITS) -> DataFrame:
    """Mergeable sketch of the latencies of each group: columns ``by``, low, width, n.

    A bucket holds the microseconds from ``low`` up to ``low + width``; its width is a power of two, at most
    ``low / 2^bits``, or one. A group has at most ``(63 - bits) * 2^bits + 2`` buckets whatever its size, all
    negative values are one with a NULL ``low``, and counting combines before the shuffle.
    """
    micros = (F.unix_micros(later) - F.unix_micros(earlier)).alias("_v")
    shift = F.greatest(F.length(F.bin("_v")) - (bits + 1), F.lit(0))
    usable = F.col("_v") >= 0
    return (
        df.select(*by, micros).where("_v IS NOT NULL").withColumn("_s", F.when(usable, shift))
        .groupBy(*by, F.expr("shiftleft(shiftright(_v, _s), _s)").alias("low"), F.expr("shiftleft(1L, _s)").alias("width"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def latency_rollup(sketches: DataFrame, by=()) -> DataFrame:
    """Merges sketches over all groups that ``by`` joins and reads percentiles off them.

    A percentile is given by the bounds ``<name>_low`` and ``<name>_high`` of the bucket with the value of rank
    ``floor(p * (measured - 1))``; the value lies from the lower up to, but not at, the upper one. Nothing is sorted but the
    merged buckets of a group, whose number is bounded.
    """
    merged = sketches.groupBy(*by, "low", "width").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by)
    count = F.when(F.col("low").isNotNull(), F.col("n")).otherwise(0)
    ranked = merged.select(
        *by, "low", "width", "n", F.sum(count).over(group).alias("_measured"),
        F.sum(count).over(group.orderBy("low").rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_upto"),
    )
    picks = []
    for name, p in PERCENTILES.items():
        rank = F.floor(p * (F.col("_measured") - 1))
        here = F.col("low").isNotNull() & (F.col("_upto") - F.col("n") <= rank) & (rank < F.col("_upto"))
        picks += [
            (F.max(F.when(here, F.col("low"))) / 1e6).alias(f"{name}_low"),
            (F.max(F.when(here, F.col("low") + F.col("width"))) / 1e6).alias(f"{name}_high"),
        ]
    return ranked.groupBy(*by).agg(
        F.coalesce(F.max("_measured"), F.lit(0)).alias("measured"),
        F.coalesce(F.sum(F.when(F.col("low").isNull(), F.col("n"))), F.lit(0)).alias("negative"),
        *picks,
    )


def gold_latency(valid: DataFrame, publishes: DataFrame, buckets: str = "1 day") -> DataFrame:
    """Seconds from collection to the first publish that could contain the event.

    ``publishes`` holds one row per run: its time and the ingestion boundary it covered.
    An event belongs to the first run whose boundary reaches the end of its bucket, however many
    publishes were missed in between; without such a run its publish time is NULL. The run is looked
    up once per bucket, and events join to the buckets.
    """
    rows = valid.withColumn("covered_until", F.window("ingested_at", buckets)["end"])
    runs = publishes.groupBy("covered_until").agg(F.min("published_at").alias("_run"))
    ends = rows.select("covered_until").union(runs.select("covered_until")).distinct()
    # One row per bucket of the time range from here on.
    onward = Window.orderBy("covered_until").rowsBetween(0, Window.unboundedFollowing)
    first = F.first("_run", ignorenulls=True).over(onward)
    found = ends.join(runs, "covered_until", "left").select("covered_until", first.alias("published_at"))
    return rows.join(found, "covered_until", "left").select("received_at", "published_at")


def freshness(df: DataFrame, at: str, as_of: Column, heartbeat: str | None = None) -> DataFrame:
    """Seconds from the newest row to the given time, beside the newest sign of any input."""
    newest = df.agg(F.max(at).alias("newest"), F.max(heartbeat or at).alias("heartbeat"))
    return newest.select(
        "newest", seconds_between(as_of, F.col("newest")).alias("age_seconds"), "heartbeat"
    )


def duplicate_rate(deliveries: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Per closed window: parseable deliveries and those whose id was seen before.

    Counts per (id, window) come first and combine map-side. A hot id is then one row per
    window, which the time range bounds, when the first window of each id is looked up.
    """
    per = deliveries.groupBy(event_id, "window_start").agg(F.count(F.lit(1)).alias("n"))
    first = F.min("window_start").over(Window.partitionBy(event_id))
    fresh = F.when(F.col("window_start") == F.col("first_window"), 1).otherwise(0)
    return (
        per.withColumn("first_window", first)
        .groupBy("window_start")
        .agg(F.sum("n").alias("parseable"), F.sum(F.col("n") - fresh).alias("duplicates"))
        .withColumn("rate", F.try_divide("duplicates", "parseable"))
    )


def invalid_rate(classified: DataFrame, by=()) -> DataFrame:
    counts = classified.groupBy(*by).agg(
        F.count_if(F.col("route") == "quarantine").alias("invalid"),
        F.count(F.lit(1)).alias("deliveries"),
    )
    return counts.withColumn("rate", F.try_divide("invalid", "deliveries"))


def late_rate(valid: DataFrame, threshold_seconds: int = 1800, by=()) -> DataFrame:
    late = seconds_between(F.col("received_at"), F.col("event_time")) > threshold_seconds
    counts = valid.groupBy(*by).agg(
        F.count_if(late).alias("late"), F.count(F.lit(1)).alias("valid")
    )
    return counts.withColumn("rate", F.try_divide("late", "valid"))


def recovery_seconds(runs: DataFrame) -> DataFrame:
    """Failure injection to the first caught-up run after it, per incident."""
    return runs.groupBy("incident").agg(
        seconds_between(
            F.min(F.when(F.col("state") == "caught_up", F.col("at"))),
            F.min(F.when(F.col("state") == "failed", F.col("at"))),
        ).alias("recovery_seconds")
    )
