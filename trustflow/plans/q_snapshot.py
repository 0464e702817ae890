"""Snapshot quality, profile, comparison, merge and file round trips."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from trustflow.functions.canonical import content_digest, table_digest
from trustflow.functions.times import format_utc
from trustflow.operators import merge, snapshot
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.registry import query
from trustflow.session import scratch_dir
from trustflow.sources import files, snapshots

REGIONS = ("africa", "america", "asia", "europe", "middle east")
CHANNELS = ("automobile", "building", "furniture", "household", "machinery")
SPEC = replace(
    snapshot.SnapshotSpec(),
    key_pattern="cus_n?[0-9]{8,}",
    domains={
        "region": REGIONS,
        "membership_plan": ("basic", "premium"),
        "acquisition_channel": CHANNELS,
        "account_status": ("active", "closed", "suspended"),
    },
)
_V = sql.SNAPSHOTS
_FLAT = (
    "customer_id, CAST(signup_date AS VARCHAR) AS signup_date, region, membership_plan, "
    "acquisition_channel, account_status, epoch_us(created_at) AS created_us, "
    "epoch_us(updated_at) AS updated_us, is_deleted"
)


def flat(df, *more):
    return df.select(
        "customer_id",
        F.col("signup_date").cast("string").alias("signup_date"),
        "region",
        "membership_plan",
        "acquisition_channel",
        "account_status",
        F.unix_micros("created_at").alias("created_us"),
        F.unix_micros("updated_at").alias("updated_us"),
        "is_deleted",
        *more,
    )


# One fault per rule, each on its own share of the customers; the rest stays clean.
_NUM = "TRY_CAST(substr(customer_id, 5) AS BIGINT)"
_FAULTS = {
    "CUSTOMER_ID_INVALID": {
        "customer_id": f"CASE WHEN {_NUM} % 40 = 1 THEN concat(customer_id, 'x') ELSE customer_id END"
    },
    "VALUE_NOT_ALLOWED": {
        "region": f"CASE WHEN {_NUM} % 40 = 2 THEN 'atlantis' ELSE region END",
        "membership_plan": f"CASE WHEN {_NUM} % 40 = 3 THEN NULL ELSE membership_plan END",
    },
    "SIGNUP_DATE_TOO_EARLY": {
        "signup_date": f"CASE WHEN {_NUM} % 40 = 4 THEN DATE '2020-12-31' ELSE signup_date END"
    },
    "CREATED_AT_SIGNUP_MISMATCH": {
        "created_at": f"CASE WHEN {_NUM} % 40 = 5 THEN created_at - INTERVAL '1' DAY * 2 "
        "ELSE created_at END"
    },
    "UPDATE_BEFORE_CREATE": {
        "updated_at": f"CASE WHEN {_NUM} % 40 = 6 THEN created_at - INTERVAL '1' SECOND * 1 "
        "ELSE updated_at END"
    },
    "UPDATE_AFTER_SNAPSHOT": {
        "updated_at": f"CASE WHEN {_NUM} % 40 = 7 THEN TIMESTAMP '2024-01-01 00:00:01' "
        "ELSE updated_at END"
    },
    "DELETED_CUSTOMER_NOT_CLOSED": {
        "is_deleted": f"CASE WHEN {_NUM} % 40 = 8 THEN true ELSE is_deleted END"
    },
}
_ID = "concat('{code}:', customer_id) AS code FROM v1 WHERE " + _NUM + " % 40 = {share}"
_WANT = {
    "CUSTOMER_ID_INVALID": "SELECT concat('CUSTOMER_ID_INVALID:', customer_id, 'x') AS code "
    f"FROM v1 WHERE {_NUM} % 40 = 1",
    "VALUE_NOT_ALLOWED": "SELECT concat('VALUE_NOT_ALLOWED:', customer_id, ':region') AS code "
    f"FROM v1 WHERE {_NUM} % 40 = 2 UNION ALL SELECT concat('VALUE_NOT_ALLOWED:', customer_id, "
    f"':membership_plan') FROM v1 WHERE {_NUM} % 40 = 3",
    "SIGNUP_DATE_TOO_EARLY": "SELECT concat('SIGNUP_DATE_TOO_EARLY:', customer_id) AS code FROM v1 "
    f"WHERE {_NUM} % 40 = 4 UNION ALL SELECT concat('CREATED_AT_SIGNUP_MISMATCH:', customer_id) "
    f"FROM v1 WHERE {_NUM} % 40 = 4",
    "CREATED_AT_SIGNUP_MISMATCH": "SELECT "
    + _ID.format(code="CREATED_AT_SIGNUP_MISMATCH", share=5),
    "UPDATE_BEFORE_CREATE": "SELECT " + _ID.format(code="UPDATE_BEFORE_CREATE", share=6),
    "UPDATE_AFTER_SNAPSHOT": "SELECT " + _ID.format(code="UPDATE_AFTER_SNAPSHOT", share=7),
    "DELETED_CUSTOMER_NOT_CLOSED": "SELECT "
    + _ID.format(code="DELETED_CUSTOMER_NOT_CLOSED", share=8),
}


def _damaged(spark, sf, code):
    faults = {n: F.expr(e) for n, e in _FAULTS[code].items()}
    return fx.snapshot_v1(spark, sf).withColumns(faults)


def _quality_query(code):
    def run(spark, sf):
        return snapshot.snapshot_errors(_damaged(spark, sf, code), SPEC, snapshot_at="2024-01-01")

    return run


for _code in _FAULTS:
    query(f"quality_{_code.lower()}", f"WITH {_V} {_WANT[_code]}")(_quality_query(_code))


@query(
    "quality_timestamp_not_utc",
    f"WITH {_V} SELECT concat('TIMESTAMP_NOT_UTC:', customer_id) AS code FROM v1 "
    f"WHERE {_NUM} % 40 IN (9, 10)",
)
def quality_timestamp_not_utc(spark, sf):
    share = F.expr(_NUM) % 40
    text = format_utc(F.col("created_at"))
    created = (
        F.when(share == 9, F.regexp_replace(text, "Z", "+01:00"))
        .when(share == 10, F.regexp_replace(text, "Z", ""))
        .otherwise(text)
    )
    rows = fx.snapshot_v1(spark, sf).withColumn("updated_at", format_utc(F.col("updated_at")))
    return snapshot.snapshot_errors(rows.withColumn("created_at", created), SPEC)


@query(
    "quality_row_count_invalid",
    "SELECT concat('ROW_COUNT_INVALID:expected=7:actual=', count(*)) AS code FROM customer",
)
def quality_row_count_invalid(spark, sf):
    return snapshot.snapshot_errors(fx.snapshot_v1(spark, sf), SPEC, expected_count=7)


@query(
    "quality_snapshot_empty",
    "SELECT unnest(['SNAPSHOT_EMPTY', concat('ROW_COUNT_INVALID:expected=', count(*), ':actual=0')]) "
    "AS code FROM customer",
)
def quality_snapshot_empty(spark, sf):
    """An extract that lost every row: all of them carry a deletion time in the far past."""
    v1 = fx.snapshot_v1(spark, sf)
    lost = v1.where(F.col("created_at") < F.lit("1970-01-01").cast("timestamp"))
    return snapshot.snapshot_errors(lost, SPEC, expected_count=v1.count())


@query(
    "quality_duplicate_customer_id",
    f"WITH {_V} SELECT concat('DUPLICATE_CUSTOMER_ID:', min(customer_id)) AS code FROM v1 "
    f"WHERE {_NUM} % 40 = 11",
)
def quality_duplicate_customer_id(spark, sf):
    v1 = fx.snapshot_v1(spark, sf)
    twice = F.when(F.expr(_NUM) % 40 == 11, 2).otherwise(1)
    rows = v1.withColumn("_c", F.explode(F.array_repeat(F.lit(1), twice))).drop("_c")
    return snapshot.snapshot_errors(rows, SPEC)


@query(
    "quality_order",
    "SELECT 'ascending' AS written, 0::BIGINT AS inversions UNION ALL "
    "SELECT 'descending', count(*) - 1 FROM customer",
)
def quality_order(spark, sf):
    """Order is a property of an exported file, so both files are written and read back."""
    folder = scratch_dir(spark, "order")
    v1 = fx.snapshot_v1(spark, sf)
    out = None
    for name, order in (("ascending", "customer_id"), ("descending", F.desc("customer_id"))):
        files.write_csv(v1, f"{folder}/{name}", order)
        stored = spark.read.option("header", True).schema("customer_id STRING").csv(f"{folder}/{name}")
        row = snapshot.order_inversions(stored, "customer_id").select(
            F.lit(name).alias("written"), "inversions"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "quality_nulls",
    f"WITH {_V}, s AS (SELECT customer_id, {_NUM} % 40 AS share FROM v1) "
    "SELECT DISTINCT CASE share WHEN 19 THEN 'CUSTOMER_ID_INVALID:' WHEN 13 THEN "
    "concat('DELETED_CUSTOMER_NOT_CLOSED:', customer_id) WHEN 16 THEN concat('TIMESTAMP_NOT_UTC:', customer_id) "
    "ELSE concat('SIGNUP_DATE_TOO_EARLY:', customer_id) END AS code FROM s WHERE share IN (12, 13, 16, 19) "
    "UNION ALL SELECT concat('CREATED_AT_SIGNUP_MISMATCH:', customer_id) FROM s WHERE share = 12",
)
def quality_nulls(spark, sf):
    """NULL in a column of the snapshot never passes the gate (one key at most is NULL here)."""
    v1 = fx.snapshot_v1(spark, sf).withColumn("_share", F.expr(f"{_NUM} % 40"))
    first = v1.where("_share = 19").agg(F.min("customer_id").alias("_first"))
    faults = {
        "signup_date": F.expr("CASE WHEN _share = 12 THEN NULL ELSE signup_date END"),
        "is_deleted": F.expr("CASE WHEN _share = 13 THEN NULL ELSE is_deleted END"),
        "created_at": F.expr("CASE WHEN _share = 16 THEN NULL ELSE created_at END"),
    }
    nameless = v1.join(first, F.col("customer_id") == F.col("_first")).withColumn("customer_id", F.lit(None).cast("string"))
    rows = v1.withColumns(faults).unionByName(nameless.select(v1.columns))
    return snapshot.snapshot_errors(rows, SPEC)


# Offenders of every constraint, each on its own share of the customers.
_BROKEN = {
    "customer_id": ((1, "concat(customer_id, 'x')"), (19, "NULL")),
    "region": ((2, "'atlantis'"), (18, "NULL")),
    "membership_plan": ((3, "NULL"), (20, "'gold'")),
    "acquisition_channel": ((14, "'radio'"), (21, "NULL")),
    "account_status": ((15, "NULL"), (22, "'lost'")),
    "signup_date": ((12, "NULL"),),
    "created_at": ((16, "NULL"),),
    "updated_at": ((17, "NULL"), (6, "created_at - INTERVAL '1' SECOND * 1")),
    "is_deleted": ((13, "NULL"),),
}
_SHARES = {
    "primary_key": (11,),
    "key_format": (1,),
    "update_order": (6,),
    **{c: tuple(share for share, _ in _BROKEN[c]) for c in SPEC.domains},
    **{f"not_null_{c}": tuple(share for share, e in _BROKEN[c] if e == "NULL") for c in SPEC.columns},
}


@query(
    "quality_constraints",
    f"WITH {_V} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS constraint_name, count(*) FILTER ({_NUM} % 40 IN ({', '.join(map(str, shares))})) "
        "AS violations FROM v1"
        for name, shares in _SHARES.items()
    ),
)
def quality_constraints(spark, sf):
    v1 = fx.snapshot_v1(spark, sf).withColumn("_share", F.expr(f"{_NUM} % 40"))
    faults = {}
    for column, cases in _BROKEN.items():
        whens = " ".join(f"WHEN {share} THEN {e}" for share, e in cases)
        faults[column] = F.expr(f"CASE _share {whens} ELSE {column} END")
    twice = F.explode(F.array_repeat(F.lit(1), F.when(F.col("_share") == 11, 2).otherwise(1)))
    return snapshot.constraint_violations(v1.withColumns(faults).withColumn("_c", twice), SPEC)


@query(
    "snapshot_profile",
    f"WITH {_V} SELECT count(*) AS row_count, count(DISTINCT customer_id) AS unique_customer_count, "
    "count(*) FILTER (NOT is_deleted) AS non_deleted_row_count, "
    "count(*) FILTER (is_deleted) AS deleted_row_count FROM v2",
)
def snapshot_profile(spark, sf):
    return snapshot.profile(fx.snapshot_v2(spark, sf), SPEC)


@query(
    "value_distributions",
    f"WITH {_V} SELECT field, value, count(*) AS n FROM (UNPIVOT (SELECT region, membership_plan, "
    "acquisition_channel, account_status FROM v2) ON region, membership_plan, acquisition_channel, "
    "account_status INTO NAME field VALUE value) GROUP BY field, value",
)
def value_distributions(spark, sf):
    return snapshot.value_distributions(fx.snapshot_v2(spark, sf), list(SPEC.domains))


_ROW = "concat_ws('|', " + ", ".join(
    f"coalesce(concat('=', CAST({c} AS VARCHAR)), '~')"
    for c in sorted(SPEC.columns)
) + ")"
_SUMS = ", ".join(
    f"sum(CAST(concat('0x', substr(h, {1 + 15 * i}, 15)) AS BIGINT)::HUGEINT) AS s{i}" for i in range(4)
)


@query(
    "content_digest",
    f"WITH {_V}, h AS (SELECT sha256({_ROW}) AS h FROM v2), b AS (SELECT "
    "CAST(CAST(concat('0x', substr(h, 61, 4)) AS INT) % 256 AS INT) AS bucket, count(*) AS rows, "
    f"{_SUMS} FROM h GROUP BY 1) SELECT bucket, rows, "
    "sha256(concat_ws(':', rows, s0, s1, s2, s3)) AS digest FROM b",
)
def content_digest_query(spark, sf):
    return content_digest(fx.snapshot_v2(spark, sf), SPEC.columns)


@query(
    "snapshot_diff",
    f"WITH {_V}, j AS (SELECT n.*, o.customer_id AS old_id, o.membership_plan AS old_plan, "
    "o.account_status AS old_status FROM v2 n LEFT JOIN v1 o USING (customer_id)) "
    "SELECT 'insert' AS operation, customer_id, '*' AS field, '' AS old_value, "
    "'created' AS new_value, epoch_us(updated_at) AS effective_us FROM j WHERE old_id IS NULL "
    "UNION ALL SELECT 'soft_delete', customer_id, 'account_status,is_deleted', "
    "concat(old_status, ',false'), 'closed,true', epoch_us(updated_at) FROM j "
    "WHERE old_id IS NOT NULL AND is_deleted "
    "UNION ALL SELECT 'update', customer_id, 'membership_plan', old_plan, membership_plan, "
    "epoch_us(updated_at) FROM j WHERE old_id IS NOT NULL AND NOT is_deleted "
    "AND old_plan <> membership_plan",
)
def snapshot_diff(spark, sf):
    changes = snapshot.diff(fx.snapshot_v1(spark, sf), fx.snapshot_v2(spark, sf), SPEC)
    return changes.select(
        "operation",
        "customer_id",
        "field",
        "old_value",
        "new_value",
        F.unix_micros("effective_at").alias("effective_us"),
    )


@query(
    "change_invariants",
    f"WITH {_V}, n AS (SELECT *, {_NUM} AS k FROM v1) SELECT violation, count(*) AS n FROM ("
    "SELECT 'CHANGED:signup_date' AS violation FROM n WHERE k % 20 IN (3, 7) AND k % 3 = 0 "
    "UNION ALL SELECT 'CHANGED_MORE_THAN_ONCE' FROM n WHERE k % 20 = 3 AND k % 7 = 0 "
    "UNION ALL SELECT 'UPDATED_AT_WRONG' FROM n WHERE k % 20 = 3 AND k % 11 = 0) GROUP BY violation",
)
def change_invariants(spark, sf):
    """The second snapshot with changes that a valid change set must not hold."""
    k = F.expr(_NUM)
    flipped = F.coalesce(k % 20 == 3, F.lit(False))  # new ids have no number
    still = F.coalesce(k % 20 == 7, F.lit(False))  # nothing else changes here
    v2 = fx.snapshot_v2(spark, sf)
    other = F.when(F.col("region") == "asia", "africa").otherwise("asia")
    spoiled = v2.withColumns(
        {
            "signup_date": F.when((flipped | still) & (k % 3 == 0), F.date_add("signup_date", 1)).otherwise(
                F.col("signup_date")
            ),
            "region": F.when(flipped & (k % 7 == 0), other).otherwise(F.col("region")),
            "updated_at": F.when(
                flipped & (k % 11 == 0), F.lit("2024-01-03").cast("timestamp")
            ).otherwise(F.col("updated_at")),
        }
    )
    broken = snapshot.change_violations(fx.snapshot_v1(spark, sf), spoiled, SPEC, "2024-01-02")
    return broken.groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@query(
    "type1_merge",
    f"WITH {_V} SELECT {_FLAT} FROM v2 UNION ALL SELECT {_FLAT} FROM v1 "
    "WHERE customer_id NOT IN (SELECT customer_id FROM v2)",
)
def type1_merge(spark, sf):
    merged = merge.type1_merge(fx.snapshot_v1(spark, sf), fx.snapshot_v2(spark, sf), "customer_id")
    return flat(merged)


@query(
    "type1_merge_partial",
    f"WITH {_V}, part AS (SELECT * FROM v2 WHERE region <> 'asia') SELECT {_FLAT} FROM part "
    f"UNION ALL SELECT {_FLAT} FROM v1 WHERE customer_id NOT IN (SELECT customer_id FROM part)",
)
def type1_merge_partial(spark, sf):
    """A snapshot without one region: its customers stay, because absence is not deletion."""
    part = fx.snapshot_v2(spark, sf).where("region <> 'asia'")
    return flat(merge.type1_merge(fx.snapshot_v1(spark, sf), part, "customer_id"))


_STALE = f"CASE WHEN {_NUM} % 4 = 0 THEN updated_at - INTERVAL '1' DAY * 400 ELSE updated_at END"


@query(
    "upsert_stale_guard",
    f"WITH {_V}, s AS (SELECT * REPLACE ({_STALE} AS updated_at) FROM v2) SELECT {_FLAT} FROM ("
    "SELECT s.* FROM s LEFT JOIN v1 t USING (customer_id) WHERE t.customer_id IS NULL "
    "OR t.updated_at <= s.updated_at UNION ALL SELECT t.* FROM v1 t LEFT JOIN s USING (customer_id) "
    "WHERE s.customer_id IS NULL OR t.updated_at > s.updated_at)",
)
def upsert_stale_guard(spark, sf):
    source = fx.snapshot_v2(spark, sf).withColumn("updated_at", F.expr(_STALE))
    return flat(merge.upsert_stale_guard(fx.snapshot_v1(spark, sf), source, "customer_id"))


@query(
    "csv_snapshot_roundtrip",
    f"WITH {_V} SELECT {_FLAT} FROM v2",
)
def csv_snapshot_roundtrip(spark, sf):
    path = scratch_dir(spark, "snapshot-csv")
    files.write_csv(fx.snapshot_v2(spark, sf), path, "customer_id")
    return flat(files.read_snapshot_csv(spark, path, SPEC.schema))


@query(
    "snapshot_publish",
    f"WITH {_V} SELECT 'v2' AS snapshot_id, epoch_us(TIMESTAMP '2024-01-02 00:00:00') "
    f"AS snapshot_us, {_FLAT} FROM v2",
)
def snapshot_publish(spark, sf):
    """Two good snapshots and a bad one in between and after; readers see the newest good one."""
    root = scratch_dir(spark, "snapshots")
    v1, v2 = fx.snapshot_v1(spark, sf), fx.snapshot_v2(spark, sf)
    bad = _damaged(spark, sf, "VALUE_NOT_ALLOWED")
    snapshots.publish(v1, root, "v1", "2024-01-01 00:00:00", SPEC)
    snapshots.publish(v2, root, "v2", "2024-01-02 00:00:00", SPEC)
    snapshots.publish(bad, root, "v3", "2024-01-03 00:00:00", SPEC)
    chosen = snapshots.active(spark, root)
    rows = snapshots.read_snapshot(spark, root, chosen.snapshot_id, SPEC)
    return flat(
        rows,
        F.lit(chosen.snapshot_id).alias("snapshot_id"),
        F.unix_micros(F.lit(chosen.snapshot_at)).alias("snapshot_us"),
    )


@query(
    "latest_snapshot",
    f"WITH {_V}, s AS (SELECT 'v1' AS snapshot_id, max(updated_at) AS snapshot_at FROM v1 UNION ALL "
    "SELECT 'v2', max(updated_at) FROM v2) SELECT snapshot_id, epoch_us(snapshot_at) AS snapshot_us "
    "FROM s ORDER BY snapshot_at DESC LIMIT 1",
)
def latest_snapshot(spark, sf):
    def stamped(df, name):
        return df.agg(F.max("updated_at").alias("snapshot_at")).withColumn(
            "snapshot_id", F.lit(name)
        )

    both = stamped(fx.snapshot_v1(spark, sf), "v1").unionByName(
        stamped(fx.snapshot_v2(spark, sf), "v2")
    )
    return snapshot.latest_snapshot(both).select(
        "snapshot_id", F.unix_micros("snapshot_at").alias("snapshot_us")
    )


@query(
    "snapshot_digest_stable",
    "SELECT count(*) AS rows, true AS same_digest FROM customer",
)
def snapshot_digest_stable(spark, sf):
    """The digest of a snapshot equals the digest of its rows in another order."""
    v1 = fx.snapshot_v1(spark, sf)
    shuffled = v1.repartitionByRange(F.desc("customer_id")).sortWithinPartitions(F.desc("customer_id"))
    a = table_digest(v1, SPEC.columns)
    b = table_digest(shuffled, SPEC.columns).select(F.col("digest").alias("other"), F.col("rows").alias("r"))
    return a.join(b, F.col("rows") == F.col("r")).select(
        "rows", (F.col("digest") == F.col("other")).alias("same_digest")
    )
