"""Broker evidence, coverage and key comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustflow.operators import classify, dedup, evidence
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.registry import query

REPORT_SIZE = 1000

# Storage faults: some deliveries are lost, some are stored twice.
_COPIES = "CASE WHEN n % 50 = 5 THEN 0 WHEN n % 50 = 6 THEN 2 ELSE 1 END"
_STORED = (
    f"{sql.EV}, wanted AS (SELECT *, concat(topic, ':', part, ':', off) AS raw_record_id FROM ev), "
    f"stored AS (SELECT wanted.*, unnest(range({_COPIES})) AS copy FROM wanted)"
)


def _number():
    """Event number behind an offset of the derived deliveries."""
    return F.floor(F.col("offset") / 2)


def faulty_copies(df):
    n = _number() % 50
    copies = F.when(n == 5, 0).when(n == 6, 2).otherwise(1)
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")


def reports(spark, sf):
    """Producer reports of at most two thousand deliveries each; every seventh one failed."""
    rows = fx.raw(spark, sf).select(
        F.floor(_number() / REPORT_SIZE).alias("report_no"),
        F.struct(
            F.decode(F.col("headers")[0]["value"], "UTF-8").alias("delivery_id"),
            F.concat(F.lit("evt_"), F.lpad(_number().cast("string"), 32, "0")).alias("event_id"),
            F.lit("ACKNOWLEDGED").alias("status"),
            "topic",
            "partition",
            "offset",
            F.lit(None).cast("int").alias("error_code"),
        ).alias("d"),
    )
    failed = F.col("report_no") % 7 == 3
    return (
        rows.groupBy("report_no")
        .agg(F.collect_list("d").alias("deliveries"))
        .select(
            "report_no",
            F.when(failed, "FAILED").otherwise("PASS").alias("status"),
            F.size("deliveries").cast("bigint").alias("planned"),
            (F.size("deliveries") - F.when(failed, 1).otherwise(0)).cast("bigint").alias("acknowledged"),
            F.lit(0).cast("bigint").alias("remaining"),
            F.lit(None).cast("string").alias("submission_error"),
            "deliveries",
        )
    )


@query(
    "report_expected_keys",
    f"WITH {sql.EV}, r AS (SELECT n // {REPORT_SIZE} AS report_no, count(*) AS size FROM ev GROUP BY 1) "
    "SELECT 'INCOMPLETE_REPORT' AS problem, count(*) AS n FROM r WHERE report_no % 7 = 3 "
    "HAVING count(*) > 0 UNION ALL SELECT 'OVERLAPPING_OFFSETS', max(size) FROM r WHERE report_no = 0 "
    "UNION ALL SELECT 'expected_keys', sum(size)::BIGINT FROM r WHERE report_no % 7 <> 3",
)
def report_expected_keys(spark, sf):
    given = reports(spark, sf)
    again = given.unionByName(given.where("report_no = 0"))
    complete = evidence.expected_keys(given.where("status = 'PASS'"))
    total = complete.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("expected_keys").alias("problem"), "n"
    )
    return evidence.report_problems(again).unionByName(total)


@query(
    "evidence_match",
    f"WITH {_STORED} SELECT raw_record_id, count(*) AS matched FROM stored GROUP BY raw_record_id",
)
def evidence_match(spark, sf):
    wanted = fx.deliveries(spark, sf).select("raw_record_id")
    stored = faulty_copies(fx.deliveries(spark, sf))
    return (
        evidence.matched(stored, wanted)
        .groupBy("raw_record_id")
        .agg(F.count(F.lit(1)).alias("matched"))
    )


@query(
    "evidence_missing",
    f"WITH {_STORED} SELECT raw_record_id FROM wanted WHERE raw_record_id NOT IN "
    "(SELECT raw_record_id FROM stored)",
)
def evidence_missing(spark, sf):
    wanted = fx.deliveries(spark, sf)
    return evidence.missing(faulty_copies(wanted), wanted)


@query(
    "dup_key_groups",
    f"WITH {_STORED} SELECT raw_record_id, count(*) AS n FROM stored GROUP BY 1 HAVING count(*) > 1",
)
def dup_key_groups(spark, sf):
    return dedup.key_groups(faulty_copies(fx.deliveries(spark, sf)), "raw_record_id")


@query(
    "evidence_summary",
    f"WITH {_STORED}, c AS (SELECT w.raw_record_id, count(s.copy) AS k FROM wanted w "
    "LEFT JOIN stored s USING (raw_record_id) GROUP BY 1) SELECT 'FAILED' AS status, "
    "count(*) AS expected_deliveries, count(*) FILTER (k > 0) AS matched_deliveries, "
    "count(*) FILTER (k > 1) AS duplicate_raw_keys, count(*) FILTER (k = 0) AS missing_raw_keys, "
    "sum(k)::BIGINT AS table_rows, count(*) FILTER (k > 1) AS global_duplicate_groups FROM c",
)
def evidence_summary(spark, sf):
    wanted = fx.deliveries(spark, sf)
    return evidence.evidence_summary(faulty_copies(wanted), wanted)


@query(
    "set_equality",
    f"WITH {_STORED} SELECT raw_record_id, 'left' AS side FROM (SELECT raw_record_id FROM wanted "
    "EXCEPT ALL SELECT raw_record_id FROM stored) UNION ALL SELECT raw_record_id, 'right' FROM "
    "(SELECT raw_record_id FROM stored EXCEPT ALL SELECT raw_record_id FROM wanted)",
)
def set_equality(spark, sf):
    wanted = fx.deliveries(spark, sf)
    return evidence.set_differences(
        wanted.select("raw_record_id"), faulty_copies(wanted).select("raw_record_id")
    )


@query(
    "case_compare",
    f"WITH {sql.DELIVERIES}, c AS (SELECT *, CASE wire_kind WHEN 'tombstone' THEN 'KAFKA_TOMBSTONE' "
    "WHEN 'short' THEN 'FRAME_TRUNCATED' WHEN 'bad_magic' THEN 'MAGIC_BYTE_INVALID' ELSE '' END "
    "AS want FROM deliveries) SELECT want AS want_codes, CASE WHEN want = codes THEN 'PASS' "
    "ELSE 'FAILED' END AS outcome, count(*) AS cases FROM c GROUP BY 1, 2",
)
def case_compare(spark, sf):
    """Expectations that know framing faults only, so business errors come out as failed cases."""
    kind = F.col("wire_kind")
    code = (
        F.when(kind == "tombstone", "KAFKA_TOMBSTONE")
        .when(kind == "short", "FRAME_TRUNCATED")
        .when(kind == "bad_magic", "MAGIC_BYTE_INVALID")
    )
    expected = fx.ev(spark, sf).select(
        F.concat_ws(":", "topic", F.col("part").cast("string"), F.col("off").cast("string")).alias(
            "raw_record_id"
        ),
        F.when(code.isNull(), "valid").otherwise("quarantine").alias("route"),
        F.array_compact(F.array(code)).alias("error_codes"),
    )
    compared = evidence.case_compare(expected, fx.kept_classified(spark, sf))
    return compared.groupBy(
        F.array_join("want_codes", ",").alias("want_codes"), "outcome"
    ).agg(F.count(F.lit(1)).alias("cases"))


@query(
    "coverage_audit",
    f"WITH {sql.DELIVERIES}, w AS (SELECT *, {_COPIES} AS copies FROM deliveries), "
    "r AS (SELECT *, CASE WHEN n % 50 = 8 THEN 'other' ELSE route END AS routed FROM w) "
    "SELECT count(*) AS input_deliveries, "
    "coalesce(sum(copies) FILTER (routed = 'valid'), 0)::BIGINT AS valid_rows, "
    "coalesce(sum(copies) FILTER (routed = 'quarantine'), 0)::BIGINT AS quarantine_rows, "
    "count(*) FILTER (copies = 0) AS missing, 0::BIGINT AS unexpected, "
    "count(*) FILTER (copies > 1) AS duplicate_keys, 0::BIGINT AS in_both_views, "
    "coalesce(sum(copies) FILTER (routed = 'other'), 0)::BIGINT AS invalid_routes FROM r",
)
def coverage_audit(spark, sf):
    routed = faulty_copies(fx.kept_classified(spark, sf))
    odd = _number() % 50 == 8
    routed = routed.withColumn("route", F.when(odd, "other").otherwise(F.col("route")))
    return evidence.coverage_audit(fx.deliveries(spark, sf), routed)


@query(
    "duplicate_flags",
    f"WITH {sql.VALID} SELECT count(*) AS deliveries, count(*) - count(DISTINCT event_id) "
    "AS duplicates FROM valid",
)
def duplicate_flags(spark, sf):
    return dedup.repeats(fx.kept_valid(spark, sf))


@query(
    "view_disjointness",
    f"WITH {sql.DELIVERIES} SELECT count(*) FILTER (route = 'valid') AS valid_rows, "
    "count(*) FILTER (route = 'quarantine') AS quarantine_rows, 0::BIGINT AS shared FROM deliveries",
)
def view_disjointness(spark, sf):
    # One pass: each view is a filter on the route, so a key in both has rows of both routes.
    per_key = fx.kept_classified(spark, sf).groupBy("raw_record_id").agg(
        F.count_if(F.col("route") == classify.VALID).alias("v"),
        F.count_if(F.col("route") == classify.QUARANTINE).alias("q"),
    )
    return per_key.agg(
        F.sum("v").alias("valid_rows"),
        F.sum("q").alias("quarantine_rows"),
        F.count_if((F.col("v") > 0) & (F.col("q") > 0)).alias("shared"),
    )
