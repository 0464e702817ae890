"""Late omissions, conflicts, affected entities and replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustflow.functions.canonical import row_text
from trustflow.sources import store


def ingested_between(df: DataFrame, start, end) -> DataFrame:
    """Deliveries by ingestion time, start inclusive and end exclusive. A table that is partitioned by
    ``ingest_date`` is read for the days of the window only."""
    at = F.col("ingested_at")
    if "ingest_date" in df.columns:
        first, last = (F.to_date(F.lit(t).cast("timestamp")) for t in (start, end))
        df = df.where(F.col("ingest_date").between(first, last))
    return df.where((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))


def missing_events(valid: DataFrame, durable: DataFrame, key: str = "event_id") -> DataFrame:
    """Valid deliveries whose event the durable table does not hold."""
    return valid.join(durable.select(key), key, "left_anti")


def conflicting_payloads(valid: DataFrame, payload, key: str = "event_id") -> DataFrame:
    """Event ids seen with more than one payload. Two hashes per id are all that is kept."""
    hashed = valid.select(key, F.sha2(row_text(payload), 256).alias("h"))
    return (
        hashed.groupBy(key)
        .agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.lit(1)).alias("deliveries"))
        .where("lo <> hi")
        .select(key, "deliveries")
    )


def affected_ids(events: DataFrame, key: str) -> DataFrame:
    return events.select(key).where(F.col(key).isNotNull()).distinct()


def rebuild_affected(
    facts: DataFrame,
    events: DataFrame,
    affected: DataFrame,
    key: str,
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Facts with the affected entities rebuilt from their whole history."""
    untouched = facts.join(affected, key, "left_anti")
    return untouched.unionByName(build(events.join(affected, key, "left_semi")))


def gap(expected: DataFrame, durable: DataFrame, key: str = "event_id") -> DataFrame:
    """Expected minus durable unique ids, and the ids on either side only, as counts."""
    e = expected.select(key).distinct().withColumn("e", F.lit(True))
    d = durable.select(key).distinct().withColumn("d", F.lit(True))
    return e.join(d, key, "full_outer").agg(
        F.count("e").alias("expected_events"),
        F.count("d").alias("durable_events"),
        (F.count("e") - F.count("d")).alias("gap"),
        F.count_if(F.col("d").isNull()).alias("missing"),
        F.count_if(F.col("e").isNull()).alias("unexpected"),
    )


def write_replay(df: DataFrame, path: str, replay_id: str) -> None:
    """Replaces only this replay's partition, so running it again changes nothing."""
    (
        df.withColumn("replay_id", F.lit(replay_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("replay_id")
        .parquet(path)
    )


def compare_rows(expected: DataFrame, other: DataFrame) -> DataFrame:
    """One row: expected_rows, replayed_rows and differing (rows that one side has more often), from one pass over both."""
    columns = sorted(expected.columns)
    text = F.sha2(row_text(columns), 256).alias("h")
    sides = expected.select(text, F.lit(1).alias("e"), F.lit(0).alias("o")).unionByName(
        other.select(text, F.lit(0).alias("e"), F.lit(1).alias("o"))
    )
    per_row = sides.groupBy("h").agg(F.sum("e").alias("e"), F.sum("o").alias("o"))
    return per_row.agg(
        F.coalesce(F.sum("e"), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("replayed_rows"),
        F.coalesce(F.sum(F.abs(F.col("e") - F.col("o"))), F.lit(0)).alias("differing"),
    )


def promote_replay(spark, path: str, replay_id: str, expected: DataFrame) -> bool:
    """Makes a replay the current one if its rows equal the expected ones; says whether it is.

    The marker comes last and is created exclusively under the next number, so readers go from one whole replay to
    another, and of two promotions at once one fails. A replay that is current already stays so.
    """
    if current_replay(spark, path) == replay_id:
        return True
    compared = compare_rows(expected, read_replay(spark, path, replay_id).select(*expected.columns)).first()
    if compared["differing"]:
        return False
    folder = f"{path}/_current"
    store.make_dirs(spark, folder)
    number = 1 + max([int(n.split(".")[0]) for n in store.data_files(spark, folder)], default=0)
    store.create_json(spark, f"{folder}/{number:08d}.json", {"replay_id": replay_id, "rows": compared["expected_rows"]})
    return True


def current_replay(spark, path: str) -> str | None:
    """The replay that was promoted last."""
    folder = f"{path}/_current"
    store.make_dirs(spark, folder)
    names = store.data_files(spark, folder)
    return store.read_json(spark, f"{folder}/{max(names)}")["replay_id"] if names else None


def read_replay(spark, path: str, replay_id: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("replay_id") == replay_id).drop("replay_id")
