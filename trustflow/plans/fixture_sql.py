"""Row-level formulas of the derived views, as SQL text that Spark and DuckDB both read.

Only the *inputs* are shared this way. The results are computed twice: by the operators
from bytes and rules, and by plain SQL in ``oracle`` texts from these columns.
"""

from __future__ import annotations

# Fault injection by arithmetic on the event number. Each level sees the previous one.
EVENT_LEVELS: list[list[tuple[str, str]]] = [
    [
        ("b", "CAST(floor((day(ts) - 1) / 3) AS BIGINT)"),
        (
            "event_name",
            "CASE WHEN n % 100 = 11 THEN 'appointment_refunded' "
            "WHEN event_type = 'view' THEN 'provider_profile_viewed' "
            "WHEN event_type = 'signup' THEN 'appointment_slot_viewed' "
            "WHEN event_type = 'click' THEN 'booking_started' "
            "WHEN event_type = 'purchase' THEN 'appointment_booked' "
            "ELSE 'video_connection_failed' END",
        ),
        ("val", "value + CASE WHEN attempt = 1 AND n % 200 = 110 THEN 1 ELSE 0 END"),
        (
            "received_at",
            "ts + INTERVAL '1' SECOND * CAST(2 + CASE WHEN n % 10 = 3 THEN 2100 ELSE 0 END "
            "+ CASE WHEN n % 5 = 4 THEN (n * 37) % 300 ELSE 0 END AS INT)",
        ),
    ],
    [
        ("send_at", "received_at + INTERVAL '1' SECOND * CAST(attempt AS INT)"),
        ("event_id", "concat('evt_', lpad(CAST(n AS STRING), 32, '0'))"),
        ("session_id", "concat('ses_', lpad(CAST(user_id * 100 + day(ts) AS STRING), 32, '0'))"),
        ("booking_journey_id", "concat('bkj_', lpad(CAST(user_id * 100 + b AS STRING), 32, '0'))"),
        (
            "event_time",
            "CASE WHEN n % 100 = 51 THEN received_at + INTERVAL '1' SECOND * 301 ELSE ts END",
        ),
        (
            "anonymous_id",
            "CASE WHEN n % 100 = 41 THEN NULL "
            "ELSE concat('anon_', lpad(CAST(user_id AS STRING), 32, '0')) END",
        ),
        (
            "customer_id",
            "CASE WHEN n % 100 = 41 "
            "OR event_name IN ('provider_profile_viewed', 'appointment_slot_viewed') THEN NULL "
            "WHEN n % 100 = 61 THEN concat('customer-', CAST(user_id AS STRING)) "
            "WHEN user_id % 10 = 9 THEN concat('cus_', CAST(90000000 + user_id AS STRING)) "
            "ELSE concat('cus_', lpad(CAST(user_id AS STRING), 8, '0')) END",
        ),
        (
            "appointment_id",
            "CASE WHEN n % 100 IN (1, 31) "
            "OR event_name NOT IN ('appointment_booked', 'video_connection_failed') THEN NULL "
            "ELSE concat('apt_', lpad(CAST(user_id * 100 + b AS STRING), 32, '0')) END",
        ),
        (
            "scheduled_start_time",
            "CASE WHEN event_name NOT IN ('appointment_booked', 'video_connection_failed') "
            "THEN NULL WHEN n % 100 = 91 THEN ts - INTERVAL '1' HOUR "
            "ELSE TIMESTAMP '2024-01-01 10:00:00' + INTERVAL '1' DAY * CAST(b * 3 + 5 AS INT) END",
        ),
        ("provider_id", "concat('prv_', lpad(CAST(k AS STRING), 6, '0'))"),
        (
            "device_type",
            "CASE WHEN n % 100 IN (1, 21) THEN 'desktop' WHEN n % 3 = 0 THEN 'mobile' "
            "WHEN n % 3 = 1 THEN 'desktop' ELSE 'tablet' END",
        ),
        (
            "platform",
            "CASE WHEN n % 100 IN (1, 21) THEN 'ios' WHEN n % 3 = 0 THEN 'ios' "
            "WHEN n % 3 = 1 THEN 'web' ELSE 'android' END",
        ),
        (
            "specialty",
            "CASE WHEN n % 100 = 71 THEN 'cardiology' WHEN k % 4 = 0 THEN 'dermatology' "
            "WHEN k % 4 = 1 THEN 'mental_health' WHEN k % 4 = 2 THEN 'pediatrics' "
            "ELSE 'primary_care' END",
        ),
        ("schema_version", "CASE WHEN n % 100 = 81 THEN 2 ELSE 1 END"),
        (
            "wire_kind",
            "CASE n % 100 WHEN 7 THEN 'tombstone' WHEN 17 THEN 'short' WHEN 27 THEN 'bad_magic' "
            "WHEN 37 THEN 'unknown_schema' WHEN 47 THEN 'other_schema' WHEN 57 THEN 'truncated' "
            "WHEN 67 THEN 'trailing' ELSE 'ok' END",
        ),
    ],
    [
        ("topic", "'events'"),
        ("part", "CAST(user_id % 4 AS INT)"),
        ("off", "n * 2 + attempt"),
        ("ingested_at", "send_at + INTERVAL '1' SECOND * 5"),
        ("processed_at", "send_at + INTERVAL '1' SECOND * CAST(5 + n % 60 AS INT)"),
    ],
]

# Customer snapshots from customer x nation x region.
SNAPSHOT_V1: list[tuple[str, str]] = [
    ("customer_id", "concat('cus_', lpad(CAST(c_custkey AS STRING), 8, '0'))"),
    (
        "signup_date",
        "CAST(TIMESTAMP '2021-01-01 00:00:00' "
        "+ INTERVAL '1' DAY * CAST(c_custkey % 1000 AS INT) AS DATE)",
    ),
    ("region", "lower(r_name)"),
    ("membership_plan", "CASE WHEN c_acctbal >= 5000 THEN 'premium' ELSE 'basic' END"),
    ("acquisition_channel", "lower(c_mktsegment)"),
    ("account_status", "CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END"),
    (
        "created_at",
        "TIMESTAMP '2021-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 1000 AS INT) "
        "+ INTERVAL '1' SECOND * CAST(c_custkey % 86400 AS INT)",
    ),
    (
        "updated_at",
        "TIMESTAMP '2021-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 1000 AS INT) "
        "+ INTERVAL '1' SECOND * CAST(c_custkey % 86400 AS INT)",
    ),
    ("is_deleted", "c_custkey < 0"),
]
V2_AT = "TIMESTAMP '2024-01-02 00:00:00'"
V1_AT = "TIMESTAMP '2024-01-01 00:00:00'"
SNAPSHOT_V2: list[tuple[str, str]] = [
    ("customer_id", "customer_id"),
    ("signup_date", "signup_date"),
    ("region", "region"),
    (
        "membership_plan",
        "CASE WHEN c_custkey % 20 = 3 THEN CASE WHEN membership_plan = 'basic' "
        "THEN 'premium' ELSE 'basic' END ELSE membership_plan END",
    ),
    ("acquisition_channel", "acquisition_channel"),
    ("account_status", "CASE WHEN c_custkey % 50 = 0 THEN 'closed' ELSE account_status END"),
    ("created_at", "created_at"),
    (
        "updated_at",
        f"CASE WHEN c_custkey % 50 = 0 OR c_custkey % 20 = 3 THEN {V2_AT} ELSE updated_at END",
    ),
    ("is_deleted", "c_custkey % 50 = 0"),
]
# A new row for every hundredth customer, created at the time of the second snapshot. Its id has a letter
# before the digits, so that it meets no other id at any scale.
SNAPSHOT_NEW: list[tuple[str, str]] = [
    ("customer_id", "concat('cus_n', lpad(CAST(c_custkey AS STRING), 8, '0'))"),
    ("signup_date", "DATE '2024-01-02'"),
    ("region", "region"),
    ("membership_plan", "membership_plan"),
    ("acquisition_channel", "acquisition_channel"),
    ("account_status", "'active'"),
    ("created_at", V2_AT),
    ("updated_at", V2_AT),
    ("is_deleted", "c_custkey < 0"),
]
SNAPSHOT_COLUMNS = tuple(name for name, _ in SNAPSHOT_V1)

AS_OF = "TIMESTAMP '2001-07-30 12:00:00'"
# Appointments from orders: what the event stream built from them must lead to.
ORDER_LEVEL: list[tuple[str, str]] = [
    ("scheduled", "o_orderdate + INTERVAL '1' HOUR * CAST(1 + 24 * (1 + o_orderkey % 3) AS INT)"),
    ("scenario", "o_orderkey % 4"),
]


def duck(levels, source: str) -> str:
    """Nested SELECTs for a list of levels."""
    sql = source
    for i, level in enumerate(levels):
        columns = ", ".join(f"{e} AS {n}" for n, e in level)
        sql = f"(SELECT *, {columns} FROM {sql} AS l{i})"
    return sql.replace("AS STRING)", "AS VARCHAR)")


_ATTEMPTS = (
    "(SELECT event_id AS n, ts, user_id, event_type, value, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
    "unnest(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS attempt FROM events)"
)

EV = f"ev AS (SELECT * FROM {duck(EVENT_LEVELS, _ATTEMPTS)} AS e)"

# Expected outcome per delivery, by plain SQL over the columns (not from the bytes).
_DESKTOP_IOS = "device_type = 'desktop' AND platform <> 'web'"
_VISIT = "event_name IN ('appointment_booked', 'video_connection_failed')"
_CODES = [
    "CASE WHEN customer_id IS NULL AND anonymous_id IS NULL THEN 'IDENTITY_REQUIRED' END",
    f"CASE WHEN customer_id IS NULL AND ({_VISIT} OR event_name = 'booking_started') "
    "THEN 'FIELD_REQUIRED:customer_id' END",
    f"CASE WHEN appointment_id IS NULL AND {_VISIT} THEN 'FIELD_REQUIRED:appointment_id' END",
    "CASE WHEN specialty = 'cardiology' THEN 'VALUE_NOT_ALLOWED:specialty' END",
    f"CASE WHEN {_DESKTOP_IOS} THEN 'DEVICE_PLATFORM_MISMATCH' END",
    "CASE WHEN customer_id LIKE 'customer-%' THEN 'IDENTIFIER_FORMAT_INVALID:customer_id' END",
    "CASE WHEN schema_version <> 1 THEN 'SCHEMA_VERSION_UNSUPPORTED' END",
    "CASE WHEN event_time > received_at + INTERVAL 300 SECOND "
    "THEN 'EVENT_TIME_TOO_FAR_IN_FUTURE' END",
    "CASE WHEN event_name = 'appointment_booked' AND scheduled_start_time < event_time "
    "THEN 'SCHEDULED_START_BEFORE_BOOKING' END",
]
BUSINESS_CODES = f"list_sort(list_distinct(list_filter([{', '.join(_CODES)}], lambda x: x IS NOT NULL)))"
_WIRE = (
    "CASE wire_kind WHEN 'tombstone' THEN ['KAFKA_TOMBSTONE'] WHEN 'short' THEN ['FRAME_TRUNCATED'] "
    "WHEN 'bad_magic' THEN ['MAGIC_BYTE_INVALID'] WHEN 'unknown_schema' THEN ['SCHEMA_ID_UNKNOWN'] "
    "WHEN 'other_schema' THEN ['WRITER_SCHEMA_UNSUPPORTED'] "
    "WHEN 'truncated' THEN ['AVRO_DECODE_FAILED'] ELSE "
    "CASE WHEN event_name = 'appointment_refunded' THEN ['AVRO_DECODE_FAILED'] "
    f"WHEN wire_kind = 'trailing' THEN ['AVRO_TRAILING_BYTES'] ELSE {BUSINESS_CODES} END END"
)
DELIVERIES = (
    f"{EV}, deliveries AS (SELECT *, concat(topic, ':', part, ':', off) AS raw_record_id, "
    f"array_to_string({_WIRE}, ',') AS codes, "
    f"CASE WHEN len({_WIRE}) = 0 THEN 'valid' ELSE 'quarantine' END AS route FROM ev)"
)
VALID = f"{DELIVERIES}, valid AS (SELECT * FROM deliveries WHERE route = 'valid')"
# First delivery of each event id.
UNIQUE = (
    f"{VALID}, uniq AS (SELECT * FROM valid QUALIFY row_number() OVER "
    "(PARTITION BY event_id ORDER BY ingested_at, off) = 1)"
)


def _select(columns, source: str) -> str:
    return (
        "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns) + f" FROM {source}"
    ).replace("AS STRING)", "AS VARCHAR)")


_V1_KEYED = (
    "SELECT c_custkey, v.* FROM (SELECT c_custkey, "
    + ", ".join(f"{e} AS {n}" for n, e in SNAPSHOT_V1)
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey) AS v"
).replace("AS STRING)", "AS VARCHAR)").replace("SELECT c_custkey, v.*", "SELECT v.*")
SNAPSHOTS = (
    f"v1k AS ({_V1_KEYED}), v1 AS (SELECT * EXCLUDE (c_custkey) FROM v1k), "
    f"v2 AS ({_select(SNAPSHOT_V2, 'v1k')} UNION ALL "
    f"{_select(SNAPSHOT_NEW, 'v1k WHERE c_custkey % 100 = 1')})"
)
APPOINTMENTS = (
    "appts AS (SELECT o_orderkey, o_custkey, booked_at, scheduled, scenario, deadline, "
    "scenario IN (0, 3) AND scheduled + INTERVAL 2 SECOND <= as_of AS started, "
    "scenario = 0 AND scheduled + INTERVAL 1802 SECOND <= as_of AS completed, "
    "as_of >= deadline AS mature, as_of FROM (SELECT *, scheduled + INTERVAL 24 HOUR AS deadline, "
    f"o_orderdate AS booked_at, {AS_OF} AS as_of FROM {duck([ORDER_LEVEL], 'orders')} AS o) "
    "AS q WHERE booked_at + INTERVAL 2 SECOND <= as_of)"
)
