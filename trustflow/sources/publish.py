"""Mart publication: facts, marts and tests come first, the marker last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustflow.sources import store


def failed_checks(checks: dict[str, DataFrame]) -> dict[str, int]:
    """Rows per failing check; every check is a frame of offending rows."""
    counts = {name: df.agg(F.count(F.lit(1)).alias("n")).first()["n"] for name, df in checks.items()}
    return {name: n for name, n in counts.items() if n}


def publish_marts(
    spark: SparkSession, root: str, run_id: str, tables: dict[str, DataFrame], checks, mart_as_of: str
) -> dict[str, int]:
    """Writes the tables of one run, runs the checks on the stored copies, then the marker."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{run_id}/{name}")
    stored = {n: spark.read.parquet(f"{root}/{run_id}/{n}") for n in tables}
    failed = failed_checks(checks(stored))
    if not failed:
        store.create_json(
            spark, f"{root}/published/{run_id}.json", {"run_id": run_id, "mart_as_of": mart_as_of}
        )
    return failed


def current_run(spark: SparkSession, root: str) -> str | None:
    folder = f"{root}/published"
    store.make_dirs(spark, folder)
    rows = spark.read.schema("run_id STRING, mart_as_of STRING").option("multiLine", True).json(folder)
    return rows.agg(F.max_by("run_id", F.struct("mart_as_of", "run_id")).alias("r")).first()["r"]
