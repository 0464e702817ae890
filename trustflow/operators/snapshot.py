"""Full-snapshot profiling, comparison and the publication quality gate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustflow.functions.ids import whole_match
from trustflow.functions.times import parse_utc


@dataclass(frozen=True)
class SnapshotSpec:
    """Names, domains and limits of a master-data snapshot."""

    key: str = "customer_id"
    key_pattern: str = "cus_[0-9]{8}"
    signup: str = "signup_date"
    created: str = "created_at"
    updated: str = "updated_at"
    deleted: str = "is_deleted"
    status: str = "account_status"
    closed: str = "closed"
    earliest_signup: str = "2021-01-01"
    # The customer domains and column order of the source table.
    domains: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "region": ("midwest", "northeast", "south", "west"),
            "membership_plan": ("basic", "premium"),
            "acquisition_channel": ("employer", "organic", "paid_search", "referral"),
            "account_status": ("active", "closed", "suspended"),
        }
    )
    columns: tuple[str, ...] = (
        "customer_id",
        "signup_date",
        "region",
        "membership_plan",
        "acquisition_channel",
        "account_status",
        "created_at",
        "updated_at",
        "is_deleted",
    )

    @property
    def schema(self) -> T.StructType:
        kinds = {
            self.signup: T.DateType(),
            self.created: T.TimestampType(),
            self.updated: T.TimestampType(),
            self.deleted: T.BooleanType(),
        }
        return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in self.columns])


def _timestamp(df: DataFrame, name: str) -> Column:
    return parse_utc(F.col(name)) if df.schema[name].dataType == T.StringType() else F.col(name)


def row_code_columns(df: DataFrame, spec: SnapshotSpec, snapshot_at=None) -> dict[str, Column]:
    """Row rules by code name; each gives the full code text or NULL. A rule that a NULL leaves
    open is broken: the source allows no NULL in any column."""
    key = F.coalesce(spec.key, F.lit(""))
    created, updated = _timestamp(df, spec.created), _timestamp(df, spec.updated)
    utc = created.isNotNull() & updated.isNotNull()

    def code(name: str, condition: Column, *suffix: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(True)), F.concat_ws(":", F.lit(name), key, *suffix))

    rules = {
        "CUSTOMER_ID_INVALID": code("CUSTOMER_ID_INVALID", ~whole_match(F.col(spec.key), spec.key_pattern)),
        "TIMESTAMP_NOT_UTC": code("TIMESTAMP_NOT_UTC", ~utc),
        "SIGNUP_DATE_TOO_EARLY": code(
            "SIGNUP_DATE_TOO_EARLY", utc & (F.col(spec.signup) < F.lit(spec.earliest_signup).cast("date"))
        ),
        "CREATED_AT_SIGNUP_MISMATCH": code(
            "CREATED_AT_SIGNUP_MISMATCH", utc & (F.to_date(created) != F.col(spec.signup))
        ),
        "UPDATE_BEFORE_CREATE": code("UPDATE_BEFORE_CREATE", utc & (updated < created)),
        "DELETED_CUSTOMER_NOT_CLOSED": code(
            "DELETED_CUSTOMER_NOT_CLOSED",
            utc & F.col(spec.deleted) & (F.col(spec.status) != spec.closed),
        ),
    }
    for name, values in spec.domains.items():
        allowed = F.coalesce(F.col(name).isin(list(values)), F.lit(False))
        rules[f"VALUE_NOT_ALLOWED:{name}"] = code("VALUE_NOT_ALLOWED", ~allowed, F.lit(name))
    if snapshot_at is not None:
        limit = snapshot_at if isinstance(snapshot_at, Column) else F.lit(snapshot_at)
        rules["UPDATE_AFTER_SNAPSHOT"] = code(
            "UPDATE_AFTER_SNAPSHOT", utc & (updated > limit.cast("timestamp"))
        )
    return rules


def row_errors(df: DataFrame, spec: SnapshotSpec, snapshot_at=None) -> DataFrame:
    """One row per broken row rule; a pure map over the snapshot."""
    rules = row_code_columns(df, spec, snapshot_at)
    codes = F.filter(F.array(*rules.values()), lambda c: c.isNotNull())
    return df.select(F.explode(codes).alias("code"))


def table_errors(df: DataFrame, spec: SnapshotSpec, expected_count: int | None = None) -> DataFrame:
    """Table-level codes. Key counts combine before the shuffle; then one row remains."""
    per_key = df.groupBy(spec.key).agg(F.count(F.lit(1)).alias("n"))
    stats = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.min(F.when(F.col("n") > 1, F.col(spec.key))).alias("first_duplicate"),
    )
    rows = F.col("rows")
    codes = [
        F.when(rows == 0, F.lit("SNAPSHOT_EMPTY")),
        F.when(
            F.col("first_duplicate").isNotNull(),
            F.concat(F.lit("DUPLICATE_CUSTOMER_ID:"), F.col("first_duplicate")),
        ),
    ]
    if expected_count is not None:
        text = F.format_string(f"ROW_COUNT_INVALID:expected={expected_count}:actual=%d", rows)
        codes.append(F.when(rows != expected_count, text))
    kept = F.filter(F.array(*codes), lambda c: c.isNotNull())
    return stats.select(F.explode(kept).alias("code"))


def order_errors(stored: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """CUSTOMER_ORDER_INVALID for stored files whose rows are not in key order."""
    broken = order_inversions(stored, spec.key).where("inversions > 0")
    return broken.select(F.lit("CUSTOMER_ORDER_INVALID").alias("code"))


def snapshot_errors(
    df: DataFrame, spec: SnapshotSpec, expected_count: int | None = None, snapshot_at=None, ordered: bool = False
) -> DataFrame:
    """Distinct error codes; no rows means the snapshot may be published. ``ordered`` asks for key
    order too, which is a property of stored files, so ``df`` must be read from files then."""
    codes = table_errors(df, spec, expected_count).unionByName(row_errors(df, spec, snapshot_at))
    if ordered:
        codes = codes.unionByName(order_errors(df, spec))
    return codes.distinct()


def order_inversions(stored: DataFrame, key: str) -> DataFrame:
    """Neighbouring rows out of key order in stored files, as one count.

    Rows compare inside one file block, whose size the reader bounds; only the first and
    last key of each block are compared across blocks.
    """
    rows = stored.select(
        key,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"),
    )
    inside = Window.partitionBy("file", "block").orderBy("i")
    per_block = (
        rows.withColumn("before", F.lag(key).over(inside))
        .groupBy("file", "block")
        .agg(
            F.count_if(F.col("before") > F.col(key)).alias("inversions"),
            F.min_by(key, "i").alias("first_key"),
            F.max_by(key, "i").alias("last_key"),
        )
    )
    # One row per block from here on.
    across = Window.orderBy("file", "block")
    joined = per_block.withColumn("before", F.lag("last_key").over(across))
    crossing = F.when(F.col("before") > F.col("first_key"), 1).otherwise(0)
    return joined.agg(
        F.coalesce(F.sum(F.col("inversions") + crossing), F.lit(0)).alias("inversions")
    )


def profile(df: DataFrame, spec: SnapshotSpec) -> DataFrame:
    per_key = df.groupBy(spec.key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(spec.deleted)).alias("d")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("unique_customer_count"),
        F.coalesce(F.sum(F.col("n") - F.col("d")), F.lit(0)).alias("non_deleted_row_count"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("deleted_row_count"),
    )


def value_distributions(df: DataFrame, columns) -> DataFrame:
    """field, value, n for several columns in one pass."""
    flat = df.select(*columns).unpivot([], list(columns), "field", "value")
    return flat.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def diff(old: DataFrame, new: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Change log between two snapshots over all columns. A key absent from the new one is not a deletion.

    Deletion and restoration say what became of status and flag together; every other column that
    differs is a change of its own. The update time belongs to each change as ``effective_at`` and is
    only listed where nothing else differs.
    """
    k = spec.key
    o = old.select(F.col(k).alias("_key"), F.struct(*spec.columns).alias("o"))
    n = new.select(F.col(k).alias("_key"), F.struct(*spec.columns).alias("n"))
    joined = n.join(o, "_key", "left")
    was, now = F.col("o"), F.col("n")
    inserted = was.isNull()
    gone, had_gone = (F.coalesce(side[spec.deleted], F.lit(False)) for side in (now, was))
    deleted, restored = ~inserted & gone & ~had_gone, ~inserted & ~gone & had_gone
    turned = deleted | restored

    def change(operation: str, name: str, before: Column, after: Column) -> Column:
        return F.struct(
            F.lit(operation).alias("operation"),
            F.lit(name).alias("field"),
            before.alias("old_value"),
            after.alias("new_value"),
        )

    def pair(side: Column) -> Column:
        return F.concat_ws(",", side[spec.status], side[spec.deleted].cast("string"))

    changes = [
        F.when(inserted, change("insert", "*", F.lit(""), F.lit("created"))),
        F.when(
            deleted, change("soft_delete", f"{spec.status},{spec.deleted}", pair(was), pair(now))
        ),
        F.when(restored, change("restore", f"{spec.status},{spec.deleted}", pair(was), pair(now))),
    ]
    for name in spec.columns:
        if name in (k, spec.updated):
            continue
        differs = ~inserted & ~was[name].eqNullSafe(now[name])
        if name in (spec.status, spec.deleted):
            differs = differs & ~turned
        changes.append(F.when(differs, change("update", name, was[name].cast("string"), now[name].cast("string"))))
    found = F.filter(F.array(*changes), lambda c: c.isNotNull())
    touched = ~inserted & ~was[spec.updated].eqNullSafe(now[spec.updated])
    only_time = change("update", spec.updated, was[spec.updated].cast("string"), now[spec.updated].cast("string"))
    listed = F.when((F.size(found) == 0) & touched, F.array(only_time)).otherwise(found)
    return joined.select("_key", "n", F.explode(listed).alias("c")).select(
        "c.operation",
        F.col("_key").alias(k),
        "c.field",
        "c.old_value",
        "c.new_value",
        F.col(f"n.{spec.updated}").alias("effective_at"),
    )


def change_violations(old: DataFrame, new: DataFrame, spec: SnapshotSpec, effective_at) -> DataFrame:
    """Broken change-set rules per key: immutable columns, update time, one change per key.

    Immutable columns are compared for every key that both snapshots have, changed otherwise or not;
    the other two rules are about the changes that a change set may hold.
    """
    k = spec.key
    frozen = [spec.signup, spec.created]
    touched = (
        diff(old, new, spec)
        .where(~F.col("field").isin(*frozen, spec.updated))
        .groupBy(k)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max(F.col("operation") == "insert").alias("_new"),
            F.max("effective_at").alias("_at"),
        )
    )
    o = old.select(k, *[F.col(c).alias(f"o_{c}") for c in frozen], F.lit(True).alias("_old"))
    both = new.select(k, *frozen).join(o, k, "left").join(touched, k, "left")
    broken = [
        F.when(F.col("_old") & ~F.col(c).eqNullSafe(F.col(f"o_{c}")), F.lit(f"CHANGED:{c}")) for c in frozen
    ]
    kept = ~F.col("_new")
    broken.append(
        F.when(kept & (F.col("_at") != F.lit(effective_at).cast("timestamp")), F.lit("UPDATED_AT_WRONG"))
    )
    broken.append(F.when(F.col("_n") > 1, F.lit("CHANGED_MORE_THAN_ONCE")))
    listed = F.filter(F.array(*broken), lambda c: c.isNotNull())
    return both.select(k, F.explode(listed).alias("violation"))


def constraint_violations(df: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Source CHECK, key and NOT NULL constraints as counts per constraint."""
    checks = {
        "key_format": ~whole_match(F.col(spec.key), spec.key_pattern),
        "update_order": F.col(spec.updated) < F.col(spec.created),
    }
    for name, values in spec.domains.items():
        checks[name] = ~F.coalesce(F.col(name).isin(list(values)), F.lit(False))
    for name in spec.columns:
        checks[f"not_null_{name}"] = F.col(name).isNull()
    again = F.when(F.col(spec.key).isNull(), 0).otherwise(F.count(F.lit(1)) - 1)
    per_key = df.groupBy(spec.key).agg(
        again.cast("long").alias("primary_key"),
        *[F.count_if(c).alias(n) for n, c in checks.items()],
    )
    names = ["primary_key", *checks]
    totals = per_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return totals.unpivot([], names, "constraint_name", "violations")


def latest_snapshot(published: DataFrame) -> DataFrame:
    """The newest published snapshot: one row with id and time."""
    return published.agg(
        F.max_by("snapshot_id", F.struct("snapshot_at", "snapshot_id")).alias("snapshot_id"),
        F.max("snapshot_at").alias("snapshot_at"),
    )


def eligible(df: DataFrame, spec: SnapshotSpec, start_at) -> DataFrame:
    """Active, not deleted, created no later than the start."""
    return df.where(
        ~F.col(spec.deleted)
        & (F.col(spec.status) == "active")
        & (F.col(spec.created) <= F.lit(start_at).cast("timestamp"))
    )
