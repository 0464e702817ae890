"""Derived views on the given tables: faulty deliveries, snapshots and an appointment stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustflow.contract import Contract, default_contract
from trustflow.functions.ids import partition_key
from trustflow.functions.times import seconds
from trustflow.operators import bronze, classify, dedup
from trustflow.plans import fixture_sql as sql
from trustflow.plans import wire
from trustflow.session import scratch_dir, tune
from trustflow.sources.kafka import KAFKA_DDL

CONTRACT: Contract = default_contract()
OTHER_SCHEMA = '{"type": "string"}'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its zone-less timestamps read as UTC timestamps."""
    df = tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name)
            if f.dataType.typeName() == "timestamp_ntz"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


#: Rows of one task where a derived table is written: what a task sorts and holds does not grow with the input.
TASK_ROWS = 50_000


def tasks_for(df: DataFrame, rows: int | None = None) -> int:
    """Tasks for the rows of a stored table (their number is in its footers), at least one per core."""
    rows = df.count() if rows is None else rows
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def spread(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """The rows by hash of their key, at any size: the given files hold one row group each, which no
    setting can split."""
    return df.repartition(tasks, key) if tasks else df.repartition(key)


def add_level(df: DataFrame, level) -> DataFrame:
    return df.select("*", *[F.expr(e).alias(n) for n, e in level])


def ev(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Contract-shaped events, one row per delivery attempt."""
    attempts = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    df = spread(table(spark, sf_dir, "events"), "event_id", tasks).select(
        F.col("event_id").alias("n"),
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.explode(attempts).alias("attempt"),
    )
    for level in sql.EVENT_LEVELS:
        df = add_level(df, level)
    return df


def derive_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with the Kafka column shape and framed Avro bytes, as a pure projection."""
    return (
        ev(spark, sf_dir, tasks_for(table(spark, sf_dir, "events")))
        .withColumn("_body", wire.datum(CONTRACT))
        .select(
            "topic",
            F.col("part").alias("partition"),
            F.col("off").alias("offset"),
            F.encode(partition_key(), "UTF-8").alias("key"),
            wire.wire_value().alias("value"),
            F.array(
                F.struct(
                    F.lit("delivery_id").alias("key"),
                    F.encode(F.concat(F.lit("delivery-"), F.col("off")), "UTF-8").alias("value"),
                )
            ).alias("headers"),
            F.col("send_at").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
    )


_STAGED: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, derive, by: tuple[str, ...] = ()) -> str:
    """Path of a derived table, written once per application to the shared folder.

    It stands for a table that the pipeline keeps. Queries on it see a real scan: filters
    and columns reach the files instead of being folded into the formulas behind them.
    """
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _STAGED:
        path = scratch_dir(spark, name)
        derive(spark, sf_dir).write.partitionBy(*by).parquet(path)
        _STAGED[at] = path
    return _STAGED[at]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored raw topic."""
    return tune(spark).read.schema(KAFKA_DDL).parquet(staged(spark, sf_dir, "raw", derive_raw))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with the fixed ingestion time of the fixture."""
    return bronze.raw_deliveries(raw(spark, sf_dir), F.col("timestamp") + seconds(5))


def catalog(spark: SparkSession) -> DataFrame:
    return classify.catalog_rows(
        spark,
        {
            wire.CONTRACT_SCHEMA_ID: CONTRACT.schema_json,
            wire.OTHER_SCHEMA_ID: OTHER_SCHEMA,
            wire.UNKNOWN_SCHEMA_ID: None,
        },
    )


def schema_lookup(schema_id: int) -> str | None:
    """Stands in for a schema registry client."""
    return {wire.CONTRACT_SCHEMA_ID: CONTRACT.schema_json, wire.OTHER_SCHEMA_ID: OTHER_SCHEMA}.get(
        schema_id
    )


def processed_time():
    number = F.floor(F.col("offset") / 2)
    return F.col("ingested_at") + F.make_dt_interval(secs=number % 60)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(
        deliveries(spark, sf_dir), catalog(spark), CONTRACT, processed_at=processed_time()
    )


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.valid_view(classified(spark, sf_dir), CONTRACT)


def derive_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries go to tasks by ranges of their ingestion time before they are classified. The writer sorts a task's wide
    classified rows by date, so a task has few of them, and few dates, at any size."""
    rows = deliveries(spark, sf_dir)
    rows = rows.repartitionByRange(tasks_for(rows), "ingested_at", "offset")
    routed = classify.classify(rows, catalog(spark), CONTRACT, processed_at=processed_time())
    return routed.withColumn("ingest_date", F.to_date("ingested_at"))


def kept_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored classified table, partitioned by ingestion date: what the classification job keeps."""
    return spark.read.parquet(staged(tune(spark), sf_dir, "classified", derive_classified, ("ingest_date",)))


def kept_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.valid_view(kept_classified(spark, sf_dir), CONTRACT)


def derive_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique valid events of the classified table."""
    return dedup.first_delivery(kept_valid(spark, sf_dir))


def unique_path(spark: SparkSession, sf_dir: str) -> str:
    return staged(tune(spark), sf_dir, "events", derive_unique)


def unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored unique-event table."""
    return spark.read.parquet(unique_path(spark, sf_dir))


def _v1_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select("c_custkey", *[F.expr(e).alias(n) for n, e in sql.SNAPSHOT_V1])


def snapshot_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v1_keyed(spark, sf_dir).drop("c_custkey")


def snapshot_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _v1_keyed(spark, sf_dir)
    changed = keyed.select(*[F.expr(e).alias(n) for n, e in sql.SNAPSHOT_V2])
    new = keyed.where("c_custkey % 100 = 1").select(
        *[F.expr(e).alias(n) for n, e in sql.SNAPSHOT_NEW]
    )
    return changed.unionByName(new)


def appointment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event stream from orders: booking, start and completion of each appointment."""
    orders = add_level(spread(table(spark, sf_dir, "orders"), "o_orderkey"), sql.ORDER_LEVEL)

    def action(name: str, at, when=None):
        row = F.struct(F.lit(name).alias("event_name"), at.alias("event_time"))
        return row if when is None else F.when(when, row)

    scheduled, scenario = F.col("scheduled"), F.col("scenario")
    actions = F.array_compact(
        F.array(
            action("appointment_booked", F.col("o_orderdate")),
            action("video_visit_started", scheduled, scenario.isin(0, 3)),
            action("video_connection_failed", scheduled, scenario == 1),
            action("visit_completed", scheduled + seconds(1800), scenario == 0),
        )
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("appointment_id"),
        F.concat(F.lit("j"), F.col("o_orderkey")).alias("booking_journey_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        scheduled.alias("scheduled_start_time"),
        F.lower("o_orderpriority").alias("specialty"),
        F.lower("o_orderstatus").alias("device_type"),
        F.explode(actions).alias("a"),
    ).select(
        "*",
        F.concat_ws("-", "appointment_id", F.col("a.event_name")).alias("event_id"),
        "a.event_name",
        "a.event_time",
        (F.col("a.event_time") + seconds(2)).alias("received_at"),
    ).drop("a")
