"""Merges as joins, for tables without a MERGE statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _merge(target: DataFrame, source: DataFrame, key: str, prefer_source: Column) -> DataFrame:
    """Full outer join on a unique key; ``prefer_source`` decides where both sides have a row."""
    t = target.select(F.col(key).alias("_key"), F.struct(*target.columns).alias("t"))
    s = source.select(F.col(key).alias("_key"), F.struct(*target.columns).alias("s"))
    picked = (
        F.when(F.col("s").isNull(), F.col("t"))
        .when(F.col("t").isNull(), F.col("s"))
        .when(prefer_source, F.col("s"))
        .otherwise(F.col("t"))
    )
    return t.join(s, "_key", "full_outer").select(picked.alias("m")).select("m.*")


def type1_merge(target: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Snapshot rows replace current ones, deletions stay as tombstone rows, and a row that
    the snapshot does not hold is kept: absence is not deletion."""
    return _merge(target, snapshot, key, F.lit(True))


def upsert_stale_guard(
    target: DataFrame, source: DataFrame, key: str, updated: str = "updated_at"
) -> DataFrame:
    """A source row wins unless it is older than the target row; ties overwrite."""
    return _merge(target, source, key, F.col(f"t.{updated}") <= F.col(f"s.{updated}"))


def upsert_statement(target: str, source: str, columns, key: str, updated: str = "updated_at") -> str:
    """The same guarded upsert as a MERGE statement, for table formats that support one."""
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns)
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {source} s ON t.{key} = s.{key} "
        f"WHEN MATCHED AND t.{updated} <= s.{updated} THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def insert_only_statement(target: str, source: str, key: str) -> str:
    return (
        f"MERGE INTO {target} t USING {source} s ON t.{key} = s.{key} "
        "WHEN NOT MATCHED THEN INSERT *"
    )
