"""Full-table extract over JDBC, split by a numeric or date column."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def extract_options(
    url: str,
    table: str,
    column: str,
    lower: str,
    upper: str,
    parts: int = 1,
    fetch: int = 10000,
    exported_snapshot: str | None = None,
) -> dict[str, str]:
    """Reader options. Each split reads in a transaction of its own, so several splits are one
    extract only if all of them take up the same exported snapshot (``pg_export_snapshot()`` in a
    transaction that stays open until the extract is stored); without one, only one split is allowed.
    """
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch),
        "isolationLevel": "REPEATABLE_READ",
    }
    if parts < 1:
        raise ValueError("parts must be positive")
    if parts == 1:
        return options
    if exported_snapshot is None or not re.fullmatch(r"[0-9A-Fa-f-]+", exported_snapshot):
        raise ValueError("Several splits need the id of an exported snapshot")
    return {
        **options,
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(parts),
        "sessionInitStatement": (
            "SET TRANSACTION ISOLATION LEVEL REPEATABLE READ; "
            f"SET TRANSACTION SNAPSHOT '{exported_snapshot}'"
        ),
    }


def extract_table(spark: SparkSession, options: dict[str, str], secrets: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options, **secrets).load()
