"""JSON-lines and strict CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustflow.functions.times import format_utc, parse_utc
from trustflow.session import scratch_dir
from trustflow.sources import store


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None) -> DataFrame:
    """One JSON object per line; a malformed line fails the read."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df if limit is None else df.limit(limit)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Keys in sorted order, NULL fields kept, UTC microseconds."""
    columns = [
        format_utc(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in sorted(df.schema.fields, key=lambda f: f.name)
    ]
    df.select(*columns).write.mode(mode).option("ignoreNullFields", "false").json(path)


def _strict(parsed: Column, text: Column, name: str) -> Column:
    problem = F.raise_error(F.concat(F.lit(f"Invalid {name}: "), F.coalesce(text, F.lit("(empty)"))))
    return F.when(parsed.isNull(), problem.cast("string").isNull()).otherwise(F.lit(True))


def _typed(f: T.StructField) -> Column:
    text = F.col(f.name)
    if isinstance(f.dataType, T.StringType):
        return F.coalesce(text, F.lit("")).alias(f.name)
    if isinstance(f.dataType, T.TimestampType):
        parsed = parse_utc(text)
    elif isinstance(f.dataType, T.BooleanType):
        lowered = F.lower(text)
        parsed = F.when(lowered.isin("true", "false"), lowered == "true")
    else:
        parsed = text.try_cast(f.dataType)
    return F.when(_strict(parsed, text, f.name), parsed).alias(f.name)


def read_snapshot_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose header must equal the schema; any value that does not parse fails the read."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(text_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return raw.select(*[_typed(f) for f in schema.fields])


def _as_text(f: T.StructField) -> Column:
    if isinstance(f.dataType, T.TimestampType):
        return format_utc(F.col(f.name)).alias(f.name)
    return F.col(f.name).cast("string").alias(f.name)


def write_csv(df: DataFrame, path: str, order, header: bool = True) -> None:
    """Canonical CSV: key order across and inside the part files, UTC microseconds, lower-case
    booleans. Written beside the target and moved into place when complete."""
    spark = df.sparkSession
    order = [order] if isinstance(order, (str, Column)) else list(order)
    ready = f"{path.rstrip('/')}.tmp-{scratch_dir(spark, 'csv').rsplit('-', 1)[1]}"
    text = df.orderBy(*order).select(*[_as_text(f) for f in df.schema.fields])
    text.write.option("header", header).csv(ready)
    store.replace_dir(spark, ready, path)
