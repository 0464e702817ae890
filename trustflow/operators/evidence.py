"""Broker acknowledgements against stored deliveries, and route coverage audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_DDL = (
    "status STRING, planned BIGINT, acknowledged BIGINT, remaining BIGINT, "
    "submission_error STRING, deliveries ARRAY<STRUCT<delivery_id: STRING, event_id: STRING, "
    "status: STRING, topic: STRING, partition: INT, offset: BIGINT, error_code: INT>>"
)


def with_report_id(reports: DataFrame) -> DataFrame:
    return reports.withColumn("report_id", F.monotonically_increasing_id())


def report_rows(reports: DataFrame) -> DataFrame:
    """One row per reported delivery."""
    return reports.select(
        *[c for c in reports.columns if c != "deliveries"],
        F.explode_outer("deliveries").alias("_d"),
    ).select(
        *[F.col(c) for c in reports.columns if c not in ("deliveries", "status")],
        F.col("status").alias("report_status"),
        "_d.*",
    )


def report_problems(reports: DataFrame) -> DataFrame:
    """Every reason a set of reports cannot serve as evidence: columns problem, n."""
    size = F.coalesce(F.size("deliveries"), F.lit(-1))
    whole = (
        (F.col("status") == "PASS")
        & (size > 0)
        & (F.col("planned") == size)
        & (F.col("acknowledged") == size)
    )
    d = F.col("deliveries")
    unacknowledged = F.exists(d, lambda x: ~x["status"].eqNullSafe(F.lit("ACKNOWLEDGED")))
    misplaced = F.exists(
        d,
        lambda x: x["topic"].isNull()
        | ~F.coalesce((x["partition"] >= 0) & (x["offset"] >= 0), F.lit(False)),
    )
    checked = reports.agg(
        F.count(F.lit(1)).alias("reports"),
        F.count_if(~F.coalesce(whole, F.lit(False))).alias("INCOMPLETE_REPORT"),
        F.count_if(unacknowledged).alias("UNACKNOWLEDGED_DELIVERY"),
        F.count_if(misplaced).alias("INVALID_COORDINATES"),
    ).withColumn("NO_REPORT", F.when(F.col("reports") == 0, 1).otherwise(0).cast("bigint"))
    names = ("INCOMPLETE_REPORT", "UNACKNOWLEDGED_DELIVERY", "INVALID_COORDINATES", "NO_REPORT")
    flat = checked.unpivot([], list(names), "problem", "n").where("n > 0")
    overlap = (
        expected_keys(reports)
        .groupBy("raw_record_id")
        .agg(F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 0")
        .select(F.lit("OVERLAPPING_OFFSETS").alias("problem"), "n")
    )
    return flat.unionByName(overlap)


def expected_keys(reports: DataFrame) -> DataFrame:
    return reports.select(F.explode("deliveries").alias("d")).select(
        F.concat_ws(
            ":", F.col("d.topic"), F.col("d.partition").cast("string"), F.col("d.offset").cast("string")
        ).alias("raw_record_id")
    )


def require_complete(reports: DataFrame) -> DataFrame:
    """Expected keys, or an error naming what is wrong (at most five rows reach the driver)."""
    problems = [f"{r.problem}={r.n}" for r in report_problems(reports).collect()]
    if problems:
        raise ValueError("Reports cannot serve as evidence: " + ", ".join(sorted(problems)))
    return expected_keys(reports)


def matched(raw: DataFrame, wanted: DataFrame, key: str = "raw_record_id") -> DataFrame:
    """Stored rows with a wanted key, key column only."""
    return raw.select(key).join(wanted.select(key), key)


def missing(raw: DataFrame, wanted: DataFrame, key: str = "raw_record_id") -> DataFrame:
    return wanted.select(key).distinct().join(raw.select(key), key, "left_anti")


def evidence_summary(raw: DataFrame, wanted: DataFrame, key: str = "raw_record_id") -> DataFrame:
    """One row. Both sides shrink to one row per key before they meet in a single join."""
    stored = raw.groupBy(key).agg(F.count(F.lit(1)).alias("stored"))
    asked = wanted.groupBy(key).agg(F.count(F.lit(1)).alias("asked"))
    both = stored.join(asked, key, "full_outer")
    wanted_row, present = F.col("asked").isNotNull(), F.col("stored").isNotNull()
    summary = both.agg(
        F.coalesce(F.sum("asked"), F.lit(0)).alias("expected_deliveries"),
        F.coalesce(F.sum(F.when(present, F.col("asked"))), F.lit(0)).alias("matched_deliveries"),
        F.count_if(wanted_row & (F.col("stored") > 1)).alias("duplicate_raw_keys"),
        F.count_if(wanted_row & ~present).alias("missing_raw_keys"),
        F.coalesce(F.sum("stored"), F.lit(0)).alias("table_rows"),
        F.count_if(F.col("stored") > 1).alias("global_duplicate_groups"),
    )
    ok = (F.col("missing_raw_keys") == 0) & (F.col("global_duplicate_groups") == 0)
    return summary.select(F.when(ok, "PASS").otherwise("FAILED").alias("status"), "*")


def stage_continuity(stages: DataFrame) -> DataFrame:
    """Run evidence rows (stage, query_id, run_id, table_rows, new_rows) checked against the
    stage before: row growth equals new rows, same query, another run. One row per stage."""
    prev = stages.select(
        F.col("stage_no").alias("p_no"),
        F.col("query_id").alias("p_query"),
        F.col("run_id").alias("p_run"),
        F.col("table_rows").alias("p_rows"),
    )
    joined = stages.join(prev, F.col("stage_no") == F.col("p_no") + 1, "left")
    first = F.col("p_no").isNull()
    return joined.select(
        "stage",
        "table_rows",
        (first | (F.col("table_rows") == F.col("p_rows") + F.col("new_rows"))).alias("rows_ok"),
        (first | (F.col("query_id") == F.col("p_query"))).alias("same_query"),
        (first | (F.col("run_id") != F.col("p_run"))).alias("new_run"),
    )


def coverage_audit(inputs: DataFrame, classified: DataFrame, key: str = "raw_record_id") -> DataFrame:
    """Every input delivery has exactly one outcome, in exactly one of the two routes."""
    given = inputs.select(key).distinct().withColumn("given", F.lit(True))
    routed = classified.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("route") == "valid").alias("v"),
        F.count_if(F.col("route") == "quarantine").alias("q"),
    )
    both = given.join(routed, key, "full_outer")
    return both.agg(
        F.count("given").alias("input_deliveries"),
        F.coalesce(F.sum("v"), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum("q"), F.lit(0)).alias("quarantine_rows"),
        F.count_if(F.col("n").isNull()).alias("missing"),
        F.count_if(F.col("given").isNull()).alias("unexpected"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.count_if((F.col("v") > 0) & (F.col("q") > 0)).alias("in_both_views"),
        F.coalesce(F.sum(F.col("n") - F.col("v") - F.col("q")), F.lit(0)).alias("invalid_routes"),
    )


def case_compare(expected: DataFrame, actual: DataFrame, key: str = "raw_record_id") -> DataFrame:
    """Expected route and codes (sorted arrays) beside the actual ones, with a verdict."""
    want = expected.select(
        key, F.col("route").alias("want_route"), F.array_sort("error_codes").alias("want_codes")
    )
    joined = want.join(actual.select(key, "route", "error_codes"), key, "left")
    same = F.col("route").eqNullSafe(F.col("want_route")) & F.array_sort("error_codes").eqNullSafe(
        F.col("want_codes")
    )
    return joined.withColumn("outcome", F.when(same, "PASS").otherwise("FAILED"))


def set_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on one side only, copies included, with the side they are on."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(
        right.exceptAll(left).withColumn("side", F.lit("right"))
    )
