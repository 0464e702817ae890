"""Delivery reports and run evidence as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trustflow.operators.evidence import REPORT_DDL
from trustflow.sources import store


def read_reports(spark: SparkSession, path) -> DataFrame:
    """One row per report file."""
    return spark.read.schema(REPORT_DDL).option("multiLine", True).option("mode", "FAILFAST").json(path)


def write_report_rows(df: DataFrame, path: str) -> None:
    """One-row manifests and reports; an existing target is an error."""
    df.coalesce(1).write.mode("errorifexists").json(path)


def save_evidence(spark: SparkSession, folder: str, name: str, data: dict) -> str:
    path = f"{folder.rstrip('/')}/{name}.json"
    store.create_json(spark, path, data)
    return path
