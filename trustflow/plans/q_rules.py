"""One query per validation rule, on the typed columns or on JSON text."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustflow.functions.times import format_utc
from trustflow.operators import json_events, rules
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.registry import query

CODES_SQL = "SELECT codes, count(*) AS deliveries FROM ({inner}) GROUP BY codes"


def _rule_query(rule, changes=None):
    """Counts of the code lists that one rule gives, with some columns damaged first."""

    def run(spark, sf):
        rows = fx.ev(spark, sf)
        if changes:
            rows = rows.withColumns({n: F.expr(e) for n, e in changes.items()})
        codes = F.array_join(rules.codes(fx.CONTRACT, F.col, [rule]), ",")
        return rows.groupBy(codes.alias("codes")).agg(F.count(F.lit(1)).alias("deliveries"))

    return run


def _rule_sql(cases: list[str], changes=None) -> str:
    listed = f"list_sort(list_distinct(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)))"
    source = "ev"
    if changes:
        replaced = ", ".join(f"{e} AS {n}" for n, e in changes.items())
        source = f"(SELECT * REPLACE ({replaced}) FROM ev)"
    inner = f"SELECT array_to_string({listed}, ',') AS codes FROM {source}"
    return f"WITH {sql.EV} " + CODES_SQL.format(inner=inner)


_BLANKED = {
    "session_id": "CASE WHEN n % 7 = 0 THEN '' ELSE session_id END",
    "device_type": "CASE WHEN n % 11 = 0 THEN NULL ELSE device_type END",
    "event_time": "CASE WHEN n % 13 = 0 THEN NULL ELSE event_time END",
}
_NOBODY = {
    "anonymous_id": "CASE WHEN n % 3 = 0 THEN '' ELSE anonymous_id END",
    "customer_id": "CASE WHEN n % 2 = 0 THEN NULL ELSE customer_id END",
}
_NEWLINE = {
    "event_id": "CASE WHEN n % 9 = 0 THEN concat(event_id, chr(10)) ELSE event_id END",
    "provider_id": "CASE WHEN n % 8 = 0 THEN concat(provider_id, 'x') ELSE provider_id END",
    "appointment_id": "CASE WHEN n % 7 = 0 THEN '' ELSE appointment_id END",
}
_DOMAINS = {
    "platform": "CASE WHEN n % 17 = 0 THEN '' ELSE platform END",
    "device_type": "CASE WHEN n % 19 = 0 THEN 'watch' ELSE device_type END",
}

query(
    "rule_required",
    _rule_sql(
        [
            "CASE WHEN n % 7 = 0 THEN 'FIELD_REQUIRED:session_id' END",
            "CASE WHEN n % 11 = 0 THEN 'FIELD_REQUIRED:device_type' END",
            "CASE WHEN n % 13 = 0 THEN 'FIELD_REQUIRED:event_time' END",
        ]
    ),
)(_rule_query(rules.required, _BLANKED))
query(
    "rule_identity",
    _rule_sql(
        [
            "CASE WHEN coalesce(anonymous_id, '') = '' AND coalesce(customer_id, '') = '' "
            "THEN 'IDENTITY_REQUIRED' END"
        ],
        _NOBODY,
    ),
)(_rule_query(rules.identity, _NOBODY))
query(
    "rule_event_required",
    _rule_sql(
        [
            "CASE WHEN customer_id IS NULL AND event_name IN ('booking_started', "
            "'appointment_booked', 'video_connection_failed') THEN 'FIELD_REQUIRED:customer_id' END",
            "CASE WHEN appointment_id IS NULL AND event_name IN ('appointment_booked', "
            "'video_connection_failed') THEN 'FIELD_REQUIRED:appointment_id' END",
        ]
    ),
)(_rule_query(rules.required_by_event))
query(
    "rule_domain",
    _rule_sql(
        [
            "CASE WHEN n % 17 = 0 THEN 'VALUE_NOT_ALLOWED:platform' END",
            "CASE WHEN n % 19 = 0 THEN 'VALUE_NOT_ALLOWED:device_type' END",
            "CASE WHEN n % 100 = 71 THEN 'VALUE_NOT_ALLOWED:specialty' END",
        ]
    ),
)(_rule_query(rules.domains, _DOMAINS))
query(
    "rule_pair_compat",
    _rule_sql(
        [
            "CASE WHEN device_type = 'desktop' AND platform <> 'web' OR device_type IN "
            "('mobile', 'tablet') AND platform = '' THEN 'DEVICE_PLATFORM_MISMATCH' END"
        ],
        _DOMAINS,
    ),
)(_rule_query(rules.pair_compatibility, _DOMAINS))
query(
    "rule_identifier",
    _rule_sql(
        [
            "CASE WHEN n % 9 = 0 THEN 'IDENTIFIER_FORMAT_INVALID:event_id' END",
            "CASE WHEN n % 8 = 0 THEN 'IDENTIFIER_FORMAT_INVALID:provider_id' END",
            "CASE WHEN customer_id LIKE 'customer-%' "
            "THEN 'IDENTIFIER_FORMAT_INVALID:customer_id' END",
        ]
    ),
)(_rule_query(rules.identifier_formats, _NEWLINE))
query(
    "rule_version",
    _rule_sql(["CASE WHEN n % 100 = 81 THEN 'SCHEMA_VERSION_UNSUPPORTED' END"]),
)(_rule_query(rules.version))
query(
    "rule_future_time",
    _rule_sql(
        [
            "CASE WHEN epoch_us(event_time) - epoch_us(received_at) > 300000000 "
            "THEN 'EVENT_TIME_TOO_FAR_IN_FUTURE' END"
        ]
    ),
)(_rule_query(rules.future_time))
query(
    "rule_sched_before_booking",
    _rule_sql(
        [
            "CASE WHEN event_name = 'appointment_booked' AND n % 100 = 91 "
            "THEN 'SCHEDULED_START_BEFORE_BOOKING' END"
        ]
    ),
)(_rule_query(rules.scheduled_before_booking))


def _json_rows(spark, sf, changes=None, extra=None):
    """Events as JSON text. ``changes`` replace fields; ``extra`` adds one outside the contract."""
    rows = fx.ev(spark, sf)
    fields = {
        f.name: format_utc(F.col(f.name)) if f.kind == "timestamp" else F.col(f.name)
        for f in fx.CONTRACT.fields
    }
    fields |= changes or {}
    text = F.to_json(
        F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}
    )
    if extra is not None:
        longer = F.concat(F.expr("substring(_t, 1, length(_t) - 1)"), F.lit(',"note":"x"}'))
        rows = rows.withColumn("_t", text)
        text = F.when(extra, longer).otherwise(F.col("_t"))
    return rows.select("n", "event_name", text.alias("json"))


def _json_codes(rows):
    checked = json_events.validate_json(rows, "json", fx.CONTRACT)
    codes = F.array_join("error_codes", ",").alias("codes")
    return checked.groupBy(codes).agg(F.count(F.lit(1)).alias("deliveries"))


def _json_sql(first: str, then: str = "") -> str:
    inner = (
        f"SELECT CASE {first} WHEN event_name = 'appointment_refunded' THEN 'AVRO_SCHEMA_INVALID' "
        f"{then} ELSE array_to_string({sql.BUSINESS_CODES}, ',') END AS codes FROM ev"
    )
    return f"WITH {sql.EV} " + CODES_SQL.format(inner=inner)


@query("rule_unknown_fields", _json_sql("WHEN n % 50 = 13 THEN 'AVRO_SCHEMA_INVALID'"))
def rule_unknown_fields(spark, sf):
    return _json_codes(_json_rows(spark, sf, extra=F.col("n") % 50 == 13))


@query(
    "rule_timestamp",
    _json_sql(
        "WHEN n % 100 IN (20, 30, 40) THEN 'TIMESTAMP_INVALID:event_time' "
        "WHEN n % 100 = 50 THEN 'TIMESTAMP_INVALID:event_time,TIMESTAMP_INVALID:received_at'"
    ),
)
def rule_timestamp(spark, sf):
    n, good = F.col("n") % 100, format_utc(F.col("event_time"))
    stamp = (
        F.when(n == 20, F.regexp_replace(good, "Z", ""))
        .when(n == 30, F.regexp_replace(good, "Z", "+02:00"))
        .when(n.isin(40, 50), F.lit("yesterday"))
        .when(n == 60, F.regexp_replace(good, "Z", "+00:00"))
        .otherwise(good)
    )
    received = F.when(n == 50, F.lit("2024-13-45T00:00:00Z")).otherwise(
        format_utc(F.col("received_at"))
    )
    return _json_codes(_json_rows(spark, sf, {"event_time": stamp, "received_at": received}))


@query(
    "rule_schema",
    _json_sql(
        "WHEN n % 100 IN (22, 32) THEN 'AVRO_SCHEMA_INVALID'",
    ),
)
def rule_schema(spark, sf):
    n = F.col("n") % 100
    session = F.when(n != 22, F.col("session_id"))
    number = F.when(n == 32, F.lit(1.5)).otherwise(F.col("schema_version").cast("double"))
    whole = _json_rows(spark, sf, {"session_id": session, "schema_version": number})
    # Whole numbers print as 1.0 from a double; only the injected 1.5 must stay fractional.
    text = F.regexp_replace("json", r'("schema_version":\d+)\.0', "$1")
    return _json_codes(whole.withColumn("json", text))


_NAMES = ", ".join(f"('{n}')" for n in fx.CONTRACT.event_names)


@query(
    "contract_symmetry",
    f"WITH {sql.EV}, known AS (SELECT * FROM (VALUES {_NAMES}) AS t(event_name)), "
    "seen AS (SELECT DISTINCT event_name FROM ev) "
    "SELECT event_name, 'data_only' AS side FROM seen WHERE event_name NOT IN (FROM known) "
    "UNION ALL SELECT event_name, 'contract_only' FROM known WHERE event_name NOT IN (FROM seen)",
)
def contract_symmetry(spark, sf):
    seen = fx.ev(spark, sf).select("event_name").distinct()
    listed = F.explode(F.array(*[F.lit(n) for n in fx.CONTRACT.event_names]))
    known = spark.range(1).select(listed.alias("event_name"))
    return (
        seen.exceptAll(known)
        .withColumn("side", F.lit("data_only"))
        .unionByName(known.exceptAll(seen).withColumn("side", F.lit("contract_only")))
    )
