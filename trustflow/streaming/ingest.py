"""Raw ingest stream: append only, one checkpoint per query."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from trustflow.operators.bronze import RAW_DDL, raw_deliveries
from trustflow.sources import store
from trustflow.streaming import binding

#: How a stream is paced: ``drain`` reads what is there and ends, ``steady`` runs on.
CADENCES = {"drain": {"availableNow": True}, "steady": {"processingTime": "10 seconds"}}


def paced(writer: DataStreamWriter, cadence: str) -> DataStreamWriter:
    if cadence not in CADENCES:
        raise ValueError(f"cadence is one of {', '.join(CADENCES)}")
    return writer.trigger(**CADENCES[cadence])


@contextmanager
def state_partitions(spark: SparkSession, count: int | None):
    """Shuffle partitions for a stateful query started inside the block.

    A query keeps the number of its first start, one state store each, so it should follow
    the cores that will run it rather than the default for batch jobs.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count or before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class RawSink:
    """Where raw rows go: a table or a path.

    Only Delta can hold a target to appends. ``enforced`` asks for that and is refused elsewhere;
    on parquet nothing but this module's own habit of appending protects the rows.
    """

    table: str | None = None
    path: str | None = None
    fmt: str = "parquet"
    enforced: bool = False

    @property
    def name(self) -> str:
        return self.table or self.path or ""

    def prepare(self, spark: SparkSession) -> None:
        """Checks the target, whichever kind it is, and creates a missing table."""
        if bool(self.table) == bool(self.path):
            raise ValueError("A raw sink is either a table or a path")
        if self.enforced and self.fmt != "delta":
            raise ValueError(f"{self.fmt} cannot enforce appends; use Delta")
        kind = f"`{self.path}`" if self.path else self.table
        reference = f"{self.fmt}.{kind}" if self.path else kind
        if self.fmt == "delta":
            rule = " TBLPROPERTIES ('delta.appendOnly' = 'true')" if self.enforced else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {reference} ({RAW_DDL}) USING delta{rule}")
            held = spark.sql(f"DESCRIBE DETAIL {reference}").first().properties
            if self.enforced and held.get("delta.appendOnly") != "true":
                raise ValueError(f"{self.name} does not enforce appends")
        elif self.table:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({RAW_DDL}) USING {self.fmt}")
        there = self.table or (store.exists(spark, self.path) and bool(store.data_files(spark, self.path)))
        if there:
            found = (spark.table(self.table) if self.table else spark.read.format(self.fmt).load(self.path)).schema
            wanted = spark.createDataFrame([], RAW_DDL).schema
            if [(f.name, f.dataType) for f in found] != [(f.name, f.dataType) for f in wanted]:
                raise ValueError(f"{self.name} does not have the columns of raw deliveries")

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        writer = writer.format(self.fmt).outputMode("append")
        return writer.toTable(self.table) if self.table else writer.start(self.path)


def start_ingest(
    kafka_rows: DataFrame,
    sink: RawSink,
    checkpoint: str,
    cadence: str = "drain",
    arrival: Column | None = None,
    name: str = "raw_ingest",
    registry: str | None = None,
    source: str = "",
) -> StreamingQuery:
    """Starts the ingest. Projection only: no shuffle, no Python. With a registry, the checkpoint
    belongs to this source and sink from its first start on."""
    spark = kafka_rows.sparkSession
    sink.prepare(spark)
    if registry:
        binding.claim(spark, registry, checkpoint, binding.Claim(name, source, sink.name))
    writer = raw_deliveries(kafka_rows, arrival).writeStream.queryName(name)
    return sink.start(paced(writer.option("checkpointLocation", checkpoint), cadence))
