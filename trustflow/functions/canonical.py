"""Canonical JSON and order-free content digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustflow.contract import Contract
from trustflow.functions.times import iso_offset


#: Fixed values of JSON text: what is escaped, and the short forms. All else is written as UTF-16 units in lower-case hex.
UNSAFE = r'[^ -~]|["\\]'
SHORT_ESCAPES = {'"': r"\"", "\\": r"\\", "\n": r"\n", "\r": r"\r", "\t": r"\t", "\f": r"\f", "\b": r"\b"}
SAFE_RUN_OR_ONE = r'(?s)[ !#-\[\]-~]+|.'


def _escaped_part(part: Column) -> Column:
    units = F.lower(F.hex(F.encode(part, "UTF-16BE")))
    out = F.when(~part.rlike(UNSAFE), part)
    for char, short in SHORT_ESCAPES.items():
        out = out.when(part == char, F.lit(short))
    return out.otherwise(F.regexp_replace(units, "(.{4})", r"\\u$1"))


def json_string(text: Column) -> Column:
    """A text between quotes in ASCII alone; characters beyond 16 bits become a surrogate pair."""
    parts = F.regexp_extract_all(text, F.lit(SAFE_RUN_OR_ONE), F.lit(0))
    return F.concat(F.lit('"'), F.array_join(F.transform(parts, _escaped_part), ""), F.lit('"'))


def event_json(event: Column, contract: Contract) -> Column:
    """Sorted keys, NULL fields kept, ISO timestamps, ASCII; ``", "`` between members and ``": "`` after keys.

    Whether anything must be escaped is asked once per event."""
    fields = sorted(contract.fields, key=lambda f: f.name)
    texts = [event[f.name] for f in fields if f.kind not in ("timestamp", "int")]

    def written(escape) -> Column:
        quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
        kinds = {"timestamp": lambda c: quoted(iso_offset(c)), "int": lambda c: c.cast("string")}
        members = [
            F.concat(F.lit(f'"{f.name}": '), F.coalesce(kinds.get(f.kind, escape or quoted)(event[f.name]), F.lit("null")))
            for f in fields
        ]
        return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))

    unsafe = F.concat_ws("", *texts).rlike(UNSAFE)
    return F.when(event.isNotNull(), F.when(unsafe, written(json_string)).otherwise(written(None)))


def canonical_schema(text: Column) -> Column:
    """JSON text with object keys in sorted order, so equal documents compare equal."""
    return F.to_json(F.parse_json(text))


def row_text(columns) -> Column:
    """One text per row; NULL and empty text stay different."""
    return F.concat_ws(
        "|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns]
    )


def content_digest(df: DataFrame, columns=None, buckets: int = 256) -> DataFrame:
    """One row per bucket: row count and a digest that does not depend on row order.

    Rows are spread by their hash. Inside a bucket the digest adds four 60-bit slices of
    each row's SHA-256 as decimals. Sums combine before the shuffle, so neither a hot
    bucket nor a large table gathers rows in one task, and copies still count.
    """
    columns = sorted(columns or df.columns)
    hashed = df.select(F.sha2(row_text(columns), 256).alias("h"))
    slices = [
        F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)
    ]
    bucket = F.conv(F.substring("h", 61, 4), 16, 10).cast("int") % buckets
    sums = [F.sum(s.cast("decimal(38,0)")).alias(f"s{i}") for i, s in enumerate(slices)]
    per_bucket = hashed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), *sums)
    joined = F.concat_ws(":", "rows", *[F.col(f"s{i}").cast("string") for i in range(4)])
    return per_bucket.select("bucket", "rows", F.sha2(joined, 256).alias("digest"))


def table_digest(df: DataFrame, columns=None, buckets: int = 256) -> DataFrame:
    """One row: total rows and the digest over the (few) bucket digests in bucket order."""
    parts = content_digest(df, columns, buckets)
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "digest")))
    return parts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.sha2(F.array_join(F.transform(ordered, lambda x: x["digest"]), ""), 256).alias("digest"),
    )
