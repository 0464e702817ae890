"""Pipeline health metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustflow.operators import health
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.q_snapshot import SPEC
from trustflow.plans.registry import query
from trustflow.session import materialize, scratch_dir
from trustflow.sources import snapshots

CLOSED = "2024-01-30 00:00:00"
_WINDOW = "time_bucket(INTERVAL 5 MINUTE, ingested_at)"
_CLOSED = f"{_WINDOW} + INTERVAL 5 MINUTE <= TIMESTAMP '{CLOSED}'"


def closed_at():
    return F.lit(CLOSED).cast("timestamp")


@query(
    "throughput_5min",
    f"WITH {sql.EV} SELECT epoch_us({_WINDOW}) AS window_us, count(*) AS deliveries FROM ev "
    f"WHERE {_CLOSED} GROUP BY 1",
)
def throughput_5min(spark, sf):
    rows = health.throughput(fx.kept_classified(spark, sf), closed_at())
    return rows.select(F.unix_micros("window_start").alias("window_us"), "deliveries")


def _profile_sql(later, earlier, source, where="true"):
    lag = f"(epoch_us({later}) - epoch_us({earlier})) / 1000000.0"
    return (
        f"SELECT count(*) FILTER (s >= 0) AS measured, count(*) FILTER (s < 0) AS negative, "
        "round(quantile_cont(s, 0.5) FILTER (s >= 0), 6) AS p50, "
        "round(quantile_cont(s, 0.95) FILTER (s >= 0), 6) AS p95, "
        f"round(max(s) FILTER (s >= 0), 6) AS max FROM (SELECT {lag}::DOUBLE AS s FROM {source} "
        f"WHERE {where})"
    )


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "latency_percentiles",
    f"WITH {sql.VALID} " + _profile_sql("received_at", "event_time", "valid"),
)
def latency_percentiles(spark, sf):
    profile = health.latency_profile(fx.kept_valid(spark, sf), "received_at", "event_time")
    return _rounded(profile, "p50", "p95", "max")


_SHIFT = "greatest(length(bin(v)) - 8, 0)"
_BOUNDS = ", ".join(
    f"max(CASE WHEN at_{k} THEN ((v >> s) << s) / 1000000.0 END) AS {k}_low, "
    f"max(CASE WHEN at_{k} THEN (((v >> s) + 1) << s) / 1000000.0 END) AS {k}_high"
    for k in ("p50", "p95")
)


@query(
    "latency_rollup",
    f"WITH {sql.VALID}, q AS (SELECT CAST(ingested_at AS DATE) AS day, epoch_us(processed_at) - epoch_us(event_time) AS v "
    f"FROM valid WHERE {_CLOSED}), k AS (SELECT day, v, row_number() OVER (PARTITION BY day, v >= 0 ORDER BY v) - 1 AS r, "
    "count(*) FILTER (v >= 0) OVER (PARTITION BY day) AS m FROM q), "
    f"b AS (SELECT day, v, CASE WHEN v >= 0 THEN {_SHIFT.replace('bin(v)', 'bin(abs(v))')} END AS s, v >= 0 AND r = floor(0.5 * (m - 1)) AS at_p50, "
    "v >= 0 AND r = floor(0.95 * (m - 1)) AS at_p95 FROM k) SELECT CAST(day AS VARCHAR) AS day, "
    f"count(*) FILTER (v >= 0) AS measured, count(*) FILTER (v < 0) AS negative, {_BOUNDS} FROM b GROUP BY day",
)
def latency_rollup(spark, sf):
    """Days of five-minute sketches merged: the stored sketches are read, no latency is sorted again."""
    windows = health.closed_windows(fx.kept_valid(spark, sf), closed_at())
    kept = materialize(health.latency_sketch(windows, "processed_at", "event_time", ["window_start"]), "latency-sketch")
    days = health.latency_rollup(kept.withColumn("day", F.to_date("window_start")), ["day"])
    return days.withColumn("day", F.col("day").cast("string"))


@query(
    "delivery_latency",
    f"WITH {sql.EV} SELECT concat(event_id, ':', attempt) AS id, "
    "round((epoch_us(received_at) - epoch_us(event_time)) / 1000000.0, 6)::DOUBLE AS seconds FROM ev",
)
def delivery_latency(spark, sf):
    return fx.ev(spark, sf).select(
        F.concat_ws(":", "event_id", "attempt").alias("id"),
        F.round(
            health.seconds_between(F.col("received_at"), F.col("event_time")), 6
        ).alias("seconds"),
    )


@query(
    "silver_latency",
    f"WITH {sql.VALID} " + _profile_sql("processed_at", "received_at", "valid"),
)
def silver_latency(spark, sf):
    profile = health.latency_profile(fx.kept_valid(spark, sf), "processed_at", "received_at")
    return _rounded(profile, "p50", "p95", "max")


_RUN_DAY = "day(covered_until) % 3 <> 1 AND covered_until < TIMESTAMP '2024-01-29 00:00:00'"


@query(
    "gold_latency",
    f"WITH {sql.VALID}, e AS (SELECT received_at, date_trunc('day', ingested_at) + INTERVAL 1 DAY AS slot "
    "FROM valid), r AS (SELECT DISTINCT date_trunc('day', ingested_at) + INTERVAL 1 DAY AS covered_until "
    f"FROM ev), k AS (SELECT * FROM r WHERE {_RUN_DAY}), n AS (SELECT slot, min(covered_until) "
    "+ INTERVAL 120 SECOND AS published_at FROM (SELECT DISTINCT slot FROM e) LEFT JOIN k ON covered_until >= slot "
    "GROUP BY slot), p AS (SELECT received_at, published_at FROM e JOIN n USING (slot)), q AS ("
    + _profile_sql("published_at", "received_at", "(SELECT * FROM p WHERE published_at IS NOT NULL) AS q0")
    + ") SELECT *, (SELECT count(*) FROM p WHERE published_at IS NULL) AS unpublished FROM q",
)
def gold_latency(spark, sf):
    """Publishes two minutes after a day of ingestion, with every third day missed and none at the end."""
    valid = fx.kept_valid(spark, sf)
    days = fx.deliveries(spark, sf).select(F.window("ingested_at", "1 day")["end"].alias("covered_until"))
    runs = days.distinct().where(_RUN_DAY).withColumn(
        "published_at", F.col("covered_until") + F.expr("INTERVAL 120 SECONDS")
    )
    covered = health.gold_latency(valid, runs)
    profile = health.latency_profile(covered, "published_at", "received_at")
    waiting = covered.agg(F.count_if(F.col("published_at").isNull()).alias("unpublished"))
    return _rounded(profile, "p50", "p95", "max").crossJoin(waiting)  # one row each


@query(
    "event_freshness",
    f"WITH {sql.VALID} SELECT epoch_us(max(event_time)) AS newest_us, round((epoch_us(TIMESTAMP "
    "'2024-02-01 00:00:00') - epoch_us(max(event_time))) / 1000000.0, 6)::DOUBLE AS age_seconds, "
    "epoch_us((SELECT max(ingested_at) FROM ev)) AS heartbeat_us FROM valid",
)
def event_freshness(spark, sf):
    now = F.lit("2024-02-01").cast("timestamp")
    # One scan: the heartbeat looks at every delivery, the event time at valid ones only.
    rows = fx.kept_classified(spark, sf).select(
        "ingested_at", F.when(F.col("route") == "valid", F.col("event.event_time")).alias("event_time")
    )
    return health.freshness(rows, "event_time", now, heartbeat="ingested_at").select(
        F.unix_micros("newest").alias("newest_us"),
        F.round("age_seconds", 6).alias("age_seconds"),
        F.unix_micros("heartbeat").alias("heartbeat_us"),
    )


@query(
    "customer_freshness",
    f"WITH {sql.SNAPSHOTS} SELECT epoch_us(TIMESTAMP '2024-01-02 00:10:00') AS newest_us, 1200.0::DOUBLE AS age_seconds, "
    "count(*) AS snapshot_rows FROM v2",
)
def customer_freshness(spark, sf):
    """Age of the newest published extraction. It is later than any row's update, and a later
    extraction that the gate refused does not count."""
    root = scratch_dir(spark, "freshness")
    v1, v2 = fx.snapshot_v1(spark, sf), fx.snapshot_v2(spark, sf)
    snapshots.publish(v1, root, "v1", "2024-01-01 00:00:00", SPEC)
    snapshots.publish(v2, root, "v2", "2024-01-02 00:10:00", SPEC)
    snapshots.publish(v2.withColumn("region", F.lit(None).cast("string")), root, "v3", "2024-01-02 00:20:00", SPEC)
    marks = snapshots.published(spark, root)
    age = health.freshness(marks, "snapshot_at", F.lit("2024-01-02 00:30:00").cast("timestamp"))
    rows = marks.agg(F.max_by("row_count", "snapshot_at").alias("snapshot_rows"))
    return age.select(
        F.unix_micros("newest").alias("newest_us"), F.round("age_seconds", 6).alias("age_seconds")
    ).crossJoin(rows)  # one row each


@query(
    "duplicate_rate",
    f"WITH {sql.DELIVERIES}, p AS (SELECT *, {_WINDOW} AS w, row_number() OVER (PARTITION BY event_id "
    "ORDER BY ingested_at, off) AS seen FROM deliveries WHERE codes NOT IN ('KAFKA_TOMBSTONE', "
    "'FRAME_TRUNCATED', 'MAGIC_BYTE_INVALID', 'SCHEMA_ID_UNKNOWN', 'WRITER_SCHEMA_UNSUPPORTED', "
    f"'AVRO_DECODE_FAILED') AND {_CLOSED}) SELECT epoch_us(w) AS window_us, count(*) AS parseable, "
    "count(*) FILTER (seen > 1) AS duplicates, "
    "round(count(*) FILTER (seen > 1) / count(*)::DOUBLE, 6) AS rate FROM p GROUP BY w",
)
def duplicate_rate(spark, sf):
    parseable = fx.kept_classified(spark, sf).where("event IS NOT NULL").select(
        "ingested_at", F.col("event.event_id").alias("event_id")
    )
    rates = health.duplicate_rate(health.closed_windows(parseable, closed_at()))
    return rates.select(
        F.unix_micros("window_start").alias("window_us"),
        "parseable",
        "duplicates",
        F.round("rate", 6).alias("rate"),
    )


@query(
    "invalid_rate",
    f"WITH {sql.DELIVERIES} SELECT epoch_us({_WINDOW}) AS window_us, "
    "count(*) FILTER (route = 'quarantine') AS invalid, count(*) AS deliveries, "
    "round(count(*) FILTER (route = 'quarantine') / count(*)::DOUBLE, 6) AS rate FROM deliveries "
    f"WHERE {_CLOSED} GROUP BY 1",
)
def invalid_rate(spark, sf):
    rows = health.closed_windows(
        fx.kept_classified(spark, sf).select("ingested_at", "ingest_date", "route"), closed_at()
    )
    rates = health.invalid_rate(rows, ["window_start"])
    return rates.select(
        F.unix_micros("window_start").alias("window_us"),
        "invalid",
        "deliveries",
        F.round("rate", 6).alias("rate"),
    )


@query(
    "late_rate",
    f"WITH {sql.VALID} SELECT CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingest_date, "
    "count(*) FILTER (received_at > event_time + INTERVAL 1800 SECOND) AS late, count(*) AS valid, "
    "round(count(*) FILTER (received_at > event_time + INTERVAL 1800 SECOND) / count(*)::DOUBLE, 6) "
    "AS rate FROM valid GROUP BY 1",
)
def late_rate(spark, sf):
    rows = fx.kept_valid(spark, sf).withColumn(
        "ingest_date", F.to_date("ingested_at").cast("string")
    )
    return _rounded(health.late_rate(rows, by=["ingest_date"]), "rate")
