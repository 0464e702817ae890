"""Kafka options. Security settings are the caller's and pass through unchanged."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Column shape of the Kafka source; file-backed deliveries use the same one.
KAFKA_DDL = (
    "topic STRING, partition INT, offset BIGINT, key BINARY, value BINARY, "
    "headers ARRAY<STRUCT<key: STRING, value: BINARY>>, timestamp TIMESTAMP, timestampType INT"
)


@dataclass(frozen=True)
class KafkaSource:
    bootstrap_servers: str
    topic: str
    max_offsets_per_trigger: int = 10000
    security: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        if not self.bootstrap_servers:
            raise ValueError("bootstrap_servers is empty")
        if not self.topic or "," in self.topic:
            raise ValueError(f"{self.topic!r} is not the name of a single topic")
        if self.max_offsets_per_trigger < 1:
            raise ValueError("a trigger must take at least one offset")
        # Option names and values of the Kafka connector.
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": "earliest",
            "failOnDataLoss": "true",
            "includeHeaders": "true",
            "kafka.allow.auto.create.topics": "false",
            **self.security,
        }


def kafka_stream(spark: SparkSession, source: KafkaSource) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**source.options())
    return reader.option("maxOffsetsPerTrigger", str(source.max_offsets_per_trigger)).load()


def kafka_batch(spark: SparkSession, source: KafkaSource, ending: str = "latest") -> DataFrame:
    """Bounded read from the earliest offset to the given end."""
    reader = spark.read.format("kafka").options(**source.options())
    return reader.option("endingOffsets", ending).load()


def delivery_file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Kafka-shaped deliveries from parquet files, rate limited like the Kafka source."""
    reader = spark.readStream.schema(KAFKA_DDL)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
