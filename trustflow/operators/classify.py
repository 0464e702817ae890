"""Delivery classification: transport, decode and business checks in fail-closed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustflow.contract import Contract
from trustflow.functions import avro, canonical, frames
from trustflow.operators import rules

VALID, QUARANTINE = "valid", "quarantine"
MAX_SCHEMA_IDS = 100
TRANSPORT_COLUMNS = (
    "raw_record_id",
    "topic",
    "partition",
    "offset",
    "schema_id",
    "rule_version",
    "ingested_at",
    "processed_at",
)


def distinct_schema_ids(deliveries: DataFrame) -> DataFrame:
    """All distinct ids in the payload headers."""
    ids = deliveries.select(frames.header_schema_id().alias("schema_id"))
    return ids.where("schema_id IS NOT NULL").distinct()


UNRESOLVED = "Schema was not resolved: "


def named_schemas(deliveries: DataFrame, limit: int = MAX_SCHEMA_IDS) -> set[int]:
    """The distinct schema ids of a batch.

    ``limit`` is a guard that fails, never a cut: each id is one call to the registry, so a batch
    that names more writers than that is taken for damage. One id beyond it is enough to tell.
    """
    named = {r.schema_id for r in distinct_schema_ids(deliveries).limit(limit + 1).collect()}
    if len(named) > limit:
        raise ValueError(f"The batch names more than {limit} writer schemas")
    return named


def resolve_schemas(deliveries: DataFrame, lookup, limit: int = MAX_SCHEMA_IDS) -> DataFrame:
    """Catalog rows for a batch. ``lookup(id)`` gives schema text or None; outages raise."""
    named = named_schemas(deliveries, limit)
    return catalog_rows(deliveries.sparkSession, {i: lookup(i) for i in sorted(named)})


class SchemaCache:
    """Schema texts kept from batch to batch, so that a batch that names known schemas is read once.

    A text never changes under its id and is kept; an id without one is asked for again in each batch. At most
    ``limit`` ids are held: beyond that only those of the batch at hand are.
    """

    def __init__(self, lookup, limit: int = MAX_SCHEMA_IDS):
        self.lookup, self.limit = lookup, limit
        self.texts: dict[int, str | None] = {}

    def run(self, deliveries: DataFrame, action) -> None:
        """``action(catalog)``, which must be repeatable. It fails on a delivery whose id is not in the catalog; the ids
        of the batch are then read and it runs again. Without known schemas they are read at once."""
        spark = deliveries.sparkSession
        self.texts = {i: self.lookup(i) if text is None else text for i, text in self.texts.items()}
        if self.texts:
            try:
                action(catalog_rows(spark, self.texts))
                return
            except Exception as failure:
                if UNRESOLVED not in str(failure):
                    raise
        named = named_schemas(deliveries, self.limit)
        new = {i: self.lookup(i) for i in sorted(named - self.texts.keys())}
        if len(self.texts) + len(new) > self.limit:
            kept = {i: text for i, text in self.texts.items() if i in named}
            self.texts = {**kept, **new}
        else:
            self.texts |= new
        action(catalog_rows(spark, self.texts))


def catalog_rows(spark, schemas: dict[int, str | None]) -> DataFrame:
    """Catalog as a literal relation, so Catalyst knows how small it is."""
    names = [F.lit(i).cast("bigint") for i in schemas]
    texts = [F.lit(t).cast("string") for t in schemas.values()]
    rows = F.explode(F.arrays_zip(F.array(*names).alias("i"), F.array(*texts).alias("t")))
    return spark.range(1).select(rows.alias("r")).select(
        F.col("r.i").alias("schema_id"),
        F.col("r.t").isNotNull().alias("schema_exists"),
        F.col("r.t").alias("schema_json"),
    )


def _frame_code(contract: Contract) -> Column:
    value = F.col("value")
    missing = F.raise_error(
        F.concat(F.lit(UNRESOLVED), F.col("_header_id").cast("string"))
    )
    return (
        F.when(value.isNull(), F.lit("KAFKA_TOMBSTONE"))
        .when(F.length(value) < frames.HEADER_BYTES, F.lit("FRAME_TRUNCATED"))
        .when(frames.magic_hex() != "00", F.lit("MAGIC_BYTE_INVALID"))
        .when(F.col("_exists").isNull(), missing)
        .when(~F.col("_exists"), F.lit("SCHEMA_ID_UNKNOWN"))
        .when(~F.col("_supported"), F.lit("WRITER_SCHEMA_UNSUPPORTED"))
    )


def classify(
    deliveries: DataFrame,
    catalog: DataFrame,
    contract: Contract,
    processed_at: Column | None = None,
) -> DataFrame:
    """Delivery columns + rule_version, route, error_codes, event_json, event, processed_at.

    ``event`` is the typed struct behind ``event_json``; downstream jobs read it instead of
    parsing the text again. The catalog is used whole; how it is joined is left to its size.
    Only frames that pass the transport checks are decoded.
    """
    supported = canonical.canonical_schema(F.col("schema_json")).eqNullSafe(
        canonical.canonical_schema(F.lit(contract.schema_json))
    )
    known = catalog.select(
        F.col("schema_id").alias("_known_id"),
        F.col("schema_exists").alias("_exists"),
        F.when(F.col("schema_exists"), supported).otherwise(False).alias("_supported"),
    )
    decode = avro.decoder(contract)
    framed = (
        deliveries.drop("schema_id")
        .withColumn("_header_id", frames.header_schema_id())
        .join(known, F.col("_header_id") == F.col("_known_id"), "left")
        .withColumn("_frame_code", _frame_code(contract))
        .withColumn("_read", decode(F.when(F.col("_frame_code").isNull(), frames.body())))
        # A filter on the outcome must not move below this point, where Spark would decode a
        # second time to evaluate it. Filters on the delivery columns still pass through.
        .select("*", F.explode(F.array("_read")).alias("_datum"))
    )
    status = F.col("_datum.status")
    event = F.when(
        status.isin(avro.DECODED, avro.TRAILING), avro.typed_event(F.col("_datum"), contract)
    )
    decoded = framed.withColumn("event", event)
    overflow = F.lit(False)
    for f in contract.fields:
        if f.kind == "int":
            overflow = overflow | (
                F.col(f"_datum.{f.name}").isNotNull() & F.col(f"event.{f.name}").isNull()
            )
    text = (
        F.when(F.col("_frame_code").isNotNull(), F.col("_frame_code"))
        .when(status == avro.FAILED, F.lit("AVRO_DECODE_FAILED"))
        .when(status == avro.TRAILING, F.lit("AVRO_TRAILING_BYTES"))
        .when(overflow, F.lit("AVRO_SCHEMA_INVALID"))
        .otherwise(rules.codes_text(contract, lambda n: F.col(f"event.{n}")))
    )
    coded = decoded.withColumn("_codes", text)
    passthrough = [c for c in deliveries.columns if c not in ("schema_id", "processed_at")]
    return coded.select(
        *passthrough,
        F.col("_header_id").alias("schema_id"),
        F.lit(contract.rule_version).alias("rule_version"),
        F.when(F.col("_codes") == "", F.lit(VALID)).otherwise(F.lit(QUARANTINE)).alias("route"),
        rules.codes_array(F.col("_codes")).alias("error_codes"),
        canonical.event_json(F.col("event"), contract).alias("event_json"),
        "event",
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
    )


def valid_view(classified: DataFrame, contract: Contract, source: str = "event") -> DataFrame:
    """Typed valid deliveries. ``source='event_json'`` parses the stored text instead."""
    valid = classified.where(F.col("route") == VALID)
    if source == "event_json":
        valid = valid.withColumn("event", F.from_json("event_json", contract.spark_schema))
    kept = [c for c in TRANSPORT_COLUMNS if c in classified.columns]
    return valid.select(*kept, *[F.col(f"event.{n}").alias(n) for n in contract.names])


def quarantine_view(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("route") == QUARANTINE)


def register_views(classified_table: str, spark, contract: Contract, prefix: str = "") -> None:
    """Persistent views over the one classified table."""
    columns = ", ".join(TRANSPORT_COLUMNS)
    fields = ", ".join(f"event.{n}" for n in contract.names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {prefix}validated_deliveries AS "
        f"SELECT {columns}, {fields} FROM {classified_table} WHERE route = '{VALID}'"
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW {prefix}quarantine_events AS "
        f"SELECT * FROM {classified_table} WHERE route = '{QUARANTINE}'"
    )


def decode_flatten(deliveries: DataFrame, schema_id: int, contract: Contract) -> DataFrame:
    """Frames of one schema id, decoded and flattened; undecodable ones give NULL fields."""
    framed = deliveries.where((frames.magic_hex() == "00") & (frames.big_endian_uint32() == schema_id))
    if avro.avro_package_available(deliveries.sparkSession):
        event = avro.from_avro_event(frames.body(), contract)
        decoded = framed.withColumn("event", event)
    else:
        read = avro.decoder(contract)(frames.body()).alias("_read")
        datum = framed.select("*", read).select("*", F.explode(F.array("_read")).alias("_datum"))
        readable = F.col("_datum.status").isin(avro.DECODED, avro.TRAILING)
        decoded = datum.withColumn(
            "event", F.when(readable, avro.typed_event(F.col("_datum"), contract))
        )
    return decoded.select(
        "topic", "partition", "offset", F.lit(schema_id).cast("bigint").alias("schema_id"), "event.*"
    )
