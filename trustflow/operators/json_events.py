"""Validation of events that arrive as JSON text: structure first, then the business rules.

The three structural stages stop at the first failing one: unknown fields, timestamps,
typed fields. The text is parsed once, into a map of variants: its keys show unknown fields, and a variant keeps
its JSON type, so a number in a text field is caught. Of a repeated key the last value counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustflow.contract import Contract, Field
from trustflow.functions.times import parse_utc
from trustflow.operators import rules

SCHEMA_INVALID = "AVRO_SCHEMA_INVALID"
INT_MIN, INT_MAX = -2147483648, 2147483647


def _value(name: str) -> Column:
    """Keys and values stand in reverse order, so the first match is the last of its name; NULL when absent."""
    return F.get("_values", F.array_position("_keys", F.lit(name)).cast("int") - 1)


def _kind(name: str) -> Column:
    """JSON type of a field: NULL when absent, VOID for an explicit null."""
    return F.schema_of_variant(_value(name))


def _text(name: str) -> Column:
    return F.try_variant_get(_value(name), "$", "string")


def unknown_fields(contract: Contract) -> Column:
    """Also true for what is no JSON object."""
    known = F.array(*[F.lit(n) for n in contract.names])
    return F.coalesce(F.size(F.array_except("_keys", known)) > 0, F.lit(True))


def timestamp_codes(contract: Contract) -> list[Column]:
    out = []
    for f in contract.timestamps:
        kind = F.col(f"_kind_{f}")
        present = kind.isNotNull() & (kind != "VOID")
        ok = (kind == "STRING") & F.col(f"event.{f}").isNotNull()
        out.append(F.when(present & ~ok, F.lit(f"TIMESTAMP_INVALID:{f}")))
    return out


def structure_invalid(contract: Contract) -> Column:
    bad = F.lit(False)
    for f in contract.fields:
        kind, text = F.col(f"_kind_{f.name}"), F.col(f"_text_{f.name}")
        if f.kind == "int":
            fits = (kind == "BIGINT") & text.try_cast("bigint").between(INT_MIN, INT_MAX)
        else:
            fits = kind == "STRING"
        if f.kind == "enum":
            fits = fits & text.isin(list(contract.event_names))
        if f.nullable:
            fits = fits | (kind == "VOID")
        absent_ok = F.lit(f.has_default)
        bad = bad | ~F.coalesce(fits, absent_ok)
    return bad


def _typed(field: Field) -> Column:
    text = F.col(f"_text_{field.name}")
    if field.kind == "timestamp":
        return parse_utc(text).alias(field.name)
    return (text.try_cast("int") if field.kind == "int" else text).alias(field.name)


def parsed(df: DataFrame, json_col: str, contract: Contract) -> DataFrame:
    """JSON types and texts per field, then typed columns as struct ``event``, each made once."""
    kinds = [_kind(n).alias(f"_kind_{n}") for n in contract.names]
    texts = [_text(n).alias(f"_text_{n}") for n in contract.names]
    read = df.withColumn("_map", F.from_json(json_col, "MAP<STRING, VARIANT>"))
    read = read.withColumns({"_keys": F.reverse(F.map_keys("_map")), "_values": F.reverse(F.map_values("_map"))})
    read = read.select("*", *kinds, *texts)
    return read.withColumn("event", F.struct(*[_typed(f) for f in contract.fields]))


def validate_json(df: DataFrame, json_col: str, contract: Contract) -> DataFrame:
    """Adds ``error_codes`` and the typed columns as struct ``event``."""
    stamps = F.concat_ws(",", *timestamp_codes(contract))
    text = (
        F.when(unknown_fields(contract), F.lit(SCHEMA_INVALID))
        .when(stamps != "", stamps)
        .when(structure_invalid(contract), F.lit(SCHEMA_INVALID))
        .otherwise(rules.codes_text(contract, lambda n: F.col(f"event.{n}")))
    )
    checked = parsed(df, json_col, contract).withColumn("_codes", text)
    return checked.select(*df.columns, rules.codes_array(F.col("_codes")).alias("error_codes"), "event")
