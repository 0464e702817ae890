"""Journey and appointment facts, marts and business metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustflow.operators import enrich, facts, marts
from trustflow.plans import fixture_sql as sql
from trustflow.plans import fixtures as fx
from trustflow.plans.q_events import durable_events, is_late
from trustflow.plans.registry import query
from trustflow.session import scratch_dir
from trustflow.sources import entities

DIMS = ("specialty", "device_type", "platform")
REBUILD_BUCKETS = 32

# Ordered stages by plain SQL: each stage is the earliest event at or after the one before.
_JOURNEYS = (
    "first_view AS (SELECT * FROM uniq WHERE event_name = 'provider_profile_viewed' QUALIFY "
    "row_number() OVER (PARTITION BY booking_journey_id ORDER BY event_time, event_id) = 1), "
    "ids AS (SELECT booking_journey_id, count(*) AS events, "
    "max(event_time) FILTER (event_name = 'appointment_slot_viewed') AS last_slot, "
    "count(*) FILTER (event_name = 'appointment_slot_viewed') AS slots, "
    "count(*) FILTER (event_name = 'booking_started') AS starts, "
    "count(*) FILTER (event_name = 'appointment_booked') AS books, "
    "count(*) FILTER (event_name = 'video_connection_failed') AS later FROM uniq GROUP BY 1), "
    "st AS (SELECT v.booking_journey_id, min(u.event_time) AS started_at FROM first_view v JOIN uniq u "
    "ON u.booking_journey_id = v.booking_journey_id AND u.event_name = 'booking_started' "
    "AND u.event_time >= v.event_time GROUP BY 1), "
    "bk AS (SELECT s.booking_journey_id, min(u.event_time) AS booked_at FROM st s JOIN uniq u "
    "ON u.booking_journey_id = s.booking_journey_id AND u.event_name = 'appointment_booked' "
    "AND u.event_time >= s.started_at GROUP BY 1), "
    "fct AS (SELECT i.booking_journey_id, v.event_time AS viewed_at, started_at, booked_at, "
    "last_slot >= v.event_time AS slot_after_view, v.specialty, v.device_type, v.platform, "
    "CAST(v.event_time AS DATE) AS cohort_date, i.events, "
    "(v.event_id IS NULL AND (slots + starts + books + later > 0)) OR (starts = 0 AND books + later > 0) "
    "OR (books = 0 AND later > 0) AS incomplete FROM ids i "
    "LEFT JOIN first_view v USING (booking_journey_id) LEFT JOIN st USING (booking_journey_id) "
    "LEFT JOIN bk USING (booking_journey_id))"
)
JOURNEYS = f"{sql.UNIQUE}, {_JOURNEYS}"
_FACT_ROW = (
    "booking_journey_id, epoch_us(viewed_at) AS viewed_us, epoch_us(started_at) AS started_us, "
    "epoch_us(booked_at) AS booked_us, slot_after_view, specialty, device_type, platform, "
    "CAST(cohort_date AS VARCHAR) AS cohort_date, events, incomplete AS incomplete_instrumentation"
)


def journey_row(df):
    return df.select(
        "booking_journey_id",
        F.unix_micros("viewed_at").alias("viewed_us"),
        F.unix_micros("started_at").alias("started_us"),
        F.unix_micros("booked_at").alias("booked_us"),
        "slot_after_view",
        *DIMS,
        F.col("cohort_date").cast("string").alias("cohort_date"),
        "events",
        "incomplete_instrumentation",
    )


def journeys(spark, sf):
    return facts.journey_fact(fx.unique_events(spark, sf))


@query("fct_journey", f"WITH {JOURNEYS} SELECT {_FACT_ROW} FROM fct")
def fct_journey(spark, sf):
    return journey_row(journeys(spark, sf))


@query(
    "first_touch_attribution",
    f"WITH {JOURNEYS} SELECT booking_journey_id, epoch_us(event_time) AS event_us, event_id, "
    "specialty, device_type, platform FROM first_view",
)
def first_touch_attribution(spark, sf):
    touched = facts.first_touch(fx.unique_events(spark, sf), facts.JourneySpec())
    return touched.select(
        "booking_journey_id", F.unix_micros("event_time").alias("event_us"), "event_id", *DIMS
    )


_TOTALS = "count(viewed_at) AS viewed, count(started_at) AS started, count(booked_at) AS booked"


def _totals(df):
    return df.agg(
        F.count("viewed_at").alias("viewed"),
        F.count("started_at").alias("started"),
        F.count("booked_at").alias("booked"),
    )


@query("ordered_funnel", f"WITH {JOURNEYS} SELECT {_TOTALS}, count(*) AS journeys FROM fct")
def ordered_funnel(spark, sf):
    return journeys(spark, sf).agg(
        F.count("viewed_at").alias("viewed"),
        F.count("started_at").alias("started"),
        F.count("booked_at").alias("booked"),
        F.count(F.lit(1)).alias("journeys"),
    )


@query(
    "funnel_counts",
    f"WITH {JOURNEYS} SELECT CAST(cohort_date AS VARCHAR) AS cohort_date, {_TOTALS} FROM fct "
    "WHERE viewed_at IS NOT NULL GROUP BY cohort_date",
)
def funnel_counts(spark, sf):
    mart = marts.booking_funnel(journeys(spark, sf), [])
    return mart.select(
        F.col("cohort_date").cast("string").alias("cohort_date"), "viewed", "started", "booked"
    )


_MART = (
    f"mart AS (SELECT cohort_date, specialty, device_type, platform, {_TOTALS}, "
    "count(*) FILTER (slot_after_view) AS slot_viewed, count(*) FILTER (incomplete) AS incomplete "
    "FROM fct WHERE viewed_at IS NOT NULL GROUP BY 1, 2, 3, 4)"
)


def funnel_mart(spark, sf):
    return marts.booking_funnel(journeys(spark, sf), DIMS)


@query(
    "mart_funnel",
    f"WITH {JOURNEYS}, {_MART} SELECT * REPLACE (CAST(cohort_date AS VARCHAR) AS cohort_date) FROM mart",
)
def mart_funnel(spark, sf):
    return funnel_mart(spark, sf).withColumn("cohort_date", F.col("cohort_date").cast("string"))


def _segmented_journeys(spark, sf):
    """Attribution with the customer attributes recorded on the first view.

    Three of four views have a customer, a tenth of these one that no snapshot holds. Each event carries the attributes of the snapshot that was active at its
    time, and a journey keeps those of its first view whatever later snapshots say.
    """
    number = F.floor(F.col("offset") / 2)
    user = F.substring("anonymous_id", 6, 32).cast("bigint").cast("string")
    seen = (F.col("event_name") == "provider_profile_viewed") & (number % 4 != 0)
    held = F.when(user % 10 == 9, F.concat(F.lit("none"), user)).otherwise(user)
    named = F.concat(F.lit("cus_"), F.lpad(held, F.greatest(F.lit(8), F.length(held)), F.lit("0")))
    events = fx.unique_events(spark, sf).withColumn("customer_id", F.when(seen, named).otherwise(F.col("customer_id")))
    before = F.col("event_time") < F.expr(sql.V2_AT)
    enriched = enrich.enrich(events.where(before), fx.snapshot_v1(spark, sf), "v1").unionByName(
        enrich.enrich(events.where(~before), fx.snapshot_v2(spark, sf), "v2")
    )
    return facts.journey_fact(enriched, dimensions=(*DIMS, *SEGMENTS))


SEGMENTS = ("customer_match_status", "region", "membership_plan", "customer_snapshot_id")


@query(
    "mart_funnel_segments",
    f"WITH {JOURNEYS}, {sql.SNAPSHOTS}, w AS (SELECT booking_journey_id, event_time < {sql.V2_AT} AS early, "
    "CASE WHEN n % 4 <> 0 AND user_id % 10 = 9 THEN 'absent' WHEN n % 4 <> 0 THEN 'cus_' || repeat('0', greatest(0, 8 - length(user_id::VARCHAR))) || user_id::VARCHAR "
    "END AS cus FROM first_view), p AS (SELECT booking_journey_id, CASE WHEN cus IS NULL THEN 'anonymous' "
    "WHEN coalesce(a.customer_id, b.customer_id) IS NULL THEN 'customer_not_found' ELSE 'matched' END AS customer_match_status, "
    "coalesce(a.region, b.region) AS region, coalesce(a.membership_plan, b.membership_plan) AS membership_plan, "
    "CASE WHEN early THEN 'v1' ELSE 'v2' END AS customer_snapshot_id FROM w "
    "LEFT JOIN v1 a ON early AND a.customer_id = cus LEFT JOIN v2 b ON NOT early AND b.customer_id = cus) "
    "SELECT specialty, customer_match_status, region, membership_plan, customer_snapshot_id, "
    f"{_TOTALS} FROM fct JOIN p USING (booking_journey_id) GROUP BY 1, 2, 3, 4, 5",
)
def mart_funnel_segments(spark, sf):
    by = ["specialty", *SEGMENTS]
    mart = marts.booking_funnel(_segmented_journeys(spark, sf), by)
    return marts.rollup(mart, by, ["viewed", "started", "booked"], {})


@query("metric_view_journeys", f"WITH {JOURNEYS} SELECT count(*) AS view_journeys FROM first_view")
def metric_view_journeys(spark, sf):
    return journeys(spark, sf).agg(F.count("viewed_at").alias("view_journeys"))


def _rate(num, den, name):
    return f"round(CASE WHEN {den} = 0 THEN NULL ELSE {num} / ({den})::DOUBLE END, 6) AS {name}"


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "metric_conversion",
    f"WITH {JOURNEYS}, {_MART} SELECT specialty, sum(viewed)::BIGINT AS viewed, "
    f"sum(booked)::BIGINT AS booked, {_rate('sum(booked)', 'sum(viewed)', 'conversion')} "
    "FROM mart GROUP BY specialty",
)
def metric_conversion(spark, sf):
    rolled = marts.rollup(
        funnel_mart(spark, sf),
        ["specialty"],
        ["viewed", "booked"],
        {"conversion": ("booked", "viewed")},
    )
    return _rounded(rolled, "conversion")


@query(
    "rollup_rates",
    f"WITH {JOURNEYS}, {_MART} SELECT device_type, platform, sum(viewed)::BIGINT AS viewed, "
    "sum(started)::BIGINT AS started, sum(booked)::BIGINT AS booked, "
    f"{_rate('sum(started)', 'sum(viewed)', 'start_rate')}, "
    f"{_rate('sum(booked)', 'sum(started)', 'book_rate')} FROM mart GROUP BY 1, 2",
)
def rollup_rates(spark, sf):
    rolled = marts.rollup(
        funnel_mart(spark, sf),
        ["device_type", "platform"],
        ["viewed", "started", "booked"],
        {"start_rate": ("started", "viewed"), "book_rate": ("booked", "started")},
    )
    return _rounded(rolled, "start_rate", "book_rate")


@query(
    "metric_steps",
    f"WITH {JOURNEYS}, s AS (SELECT CAST(cohort_date AS VARCHAR) AS cohort_date, {_TOTALS} FROM fct "
    "WHERE viewed_at IS NOT NULL GROUP BY 1) SELECT cohort_date, 'viewed_to_started' AS step, "
    f"viewed AS current, started AS next, {_rate('started', 'viewed', 'conversion')}, "
    f"{_rate('(viewed - started)', 'viewed', 'drop_off')} FROM s UNION ALL "
    "SELECT cohort_date, 'started_to_booked', started, booked, "
    f"{_rate('booked', 'started', 'conversion')}, {_rate('(started - booked)', 'started', 'drop_off')} "
    "FROM s",
)
def metric_steps(spark, sf):
    steps = marts.step_rates(funnel_mart(spark, sf), ["cohort_date"])
    steps = steps.withColumn("cohort_date", F.col("cohort_date").cast("string"))
    return _rounded(steps, "conversion", "drop_off")


@query(
    "metric_incomplete",
    f"WITH {JOURNEYS} SELECT count(*) FILTER (incomplete) AS incomplete, count(*) AS entities, "
    f"{_rate('count(*) FILTER (incomplete)', 'count(*)', 'rate')} FROM fct",
)
def metric_incomplete(spark, sf):
    counts = journeys(spark, sf).agg(
        F.count_if("incomplete_instrumentation").alias("incomplete"),
        F.count(F.lit(1)).alias("entities"),
    )
    return _rounded(counts.withColumn("rate", marts.ratio("incomplete", "entities")), "rate")


@query("affected_rebuild", f"WITH {JOURNEYS} SELECT {_FACT_ROW} FROM fct")
def affected_rebuild(spark, sf):
    """Facts without the late events, then only the buckets of touched journeys rebuilt: equal to a full build."""
    key, root = "booking_journey_id", scratch_dir(spark, "journeys")
    events = entities.EntityTable(f"{root}/events", key, REBUILD_BUCKETS)
    built = entities.EntityTable(f"{root}/facts", key, REBUILD_BUCKETS)
    events.append(durable_events(spark, sf), "load")
    built.append(facts.journey_fact(events.read(spark)), "load")
    late = fx.unique_events(spark, sf).where(is_late())
    events.append(late, "late")
    entities.rebuild(events, built, late, facts.journey_fact, "late")
    return journey_row(built.read(spark))


def as_of():
    return F.expr(sql.AS_OF)


def appointments(spark, sf):
    events = facts.visible(fx.appointment_events(spark, sf), as_of())
    return facts.appointment_fact(events, as_of())


_STATUS = (
    "CASE WHEN NOT mature THEN 'observing' WHEN completed THEN 'completed' ELSE 'incomplete' END"
)


@query(
    "fct_appointment",
    f"WITH {sql.APPOINTMENTS} SELECT CAST(o_orderkey AS VARCHAR) AS appointment_id, "
    "CAST(o_custkey AS VARCHAR) AS customer_id, epoch_us(booked_at) AS booked_us, "
    "epoch_us(scheduled) AS scheduled_us, epoch_us(deadline) AS deadline_us, mature, started, "
    f"completed, {_STATUS} AS status, CAST(CASE WHEN scenario = 1 AND scheduled + INTERVAL 2 SECOND "
    "<= as_of THEN 1 ELSE 0 END AS BIGINT) AS connection_failures FROM appts",
)
def fct_appointment(spark, sf):
    return appointments(spark, sf).select(
        "appointment_id",
        "customer_id",
        F.unix_micros("booked_at").alias("booked_us"),
        F.unix_micros("scheduled_start_time").alias("scheduled_us"),
        F.unix_micros("observation_deadline").alias("deadline_us"),
        "mature",
        "started",
        "completed",
        "status",
        "connection_failures",
    )


@query(
    "metric_incomplete_appointments",
    f"WITH {sql.APPOINTMENTS}, k AS (SELECT *, o_orderkey % 7 = 3 AS lost, scenario IN (0, 1, 3) "
    "AND scheduled + INTERVAL 2 SECOND <= as_of AS visited FROM appts) SELECT count(*) FILTER (lost AND visited) "
    "AS incomplete, count(*) FILTER (NOT lost OR visited) AS entities, count(*) FILTER (lost AND visited AND mature) "
    "AS incomplete_mature, " + _rate("count(*) FILTER (lost AND visited)", "count(*) FILTER (NOT lost OR visited)", "rate")
    + " FROM k",
)
def metric_incomplete_appointments(spark, sf):
    """Appointments whose booking event never came, a seventh of them here."""
    events = facts.visible(fx.appointment_events(spark, sf), as_of())
    lost = F.col("appointment_id").cast("bigint") % 7 == 3
    fact = facts.appointment_fact(events.where(~(lost & (F.col("event_name") == "appointment_booked"))), as_of())
    counts = fact.agg(
        F.count_if("incomplete_instrumentation").alias("incomplete"),
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("incomplete_instrumentation") & F.col("mature")).alias("incomplete_mature"),
    )
    return _rounded(counts.withColumn("rate", marts.ratio("incomplete", "entities")), "rate")


_MATURITY = (
    "count(*) FILTER (mature) AS mature, count(*) FILTER (mature AND completed) AS mature_completed, "
    "count(*) FILTER (NOT mature) AS observing"
)


@query("maturity_counts", f"WITH {sql.APPOINTMENTS} SELECT {_MATURITY} FROM appts")
def maturity_counts(spark, sf):
    mart = marts.visit_cohort(appointments(spark, sf), [])
    return marts.rollup(mart, [], ["mature", "mature_completed", "observing"], {})


@query(
    "maturity_refresh",
    f"WITH {sql.APPOINTMENTS} SELECT CASE WHEN TIMESTAMP '2001-08-01 12:00:00' < deadline "
    "THEN 'observing' WHEN completed THEN 'completed' ELSE 'incomplete' END AS status, "
    "count(*) AS appointments FROM appts GROUP BY 1",
)
def maturity_refresh(spark, sf):
    later = F.lit("2001-08-01 12:00:00").cast("timestamp")
    moved = facts.refresh_maturity(appointments(spark, sf), later)
    return moved.groupBy("status").agg(F.count(F.lit(1)).alias("appointments"))


@query(
    "mart_visit",
    f"WITH {sql.APPOINTMENTS} SELECT CAST(CAST(booked_at AS DATE) AS VARCHAR) AS cohort_date, "
    "lower(o_orderpriority) AS specialty, lower(o_orderstatus) AS device_type, count(*) AS booked, "
    f"{_MATURITY}, count(*) FILTER (mature AND started) AS mature_started, "
    "count(*) FILTER (mature AND started AND completed) AS mature_started_completed "
    "FROM (SELECT a.*, o.o_orderpriority, o.o_orderstatus FROM appts a JOIN orders o USING (o_orderkey)) "
    "GROUP BY 1, 2, 3",
)
def mart_visit(spark, sf):
    mart = marts.visit_cohort(appointments(spark, sf), ["specialty", "device_type"])
    return mart.withColumn("cohort_date", F.col("cohort_date").cast("string"))


@query(
    "metric_completion",
    f"WITH {sql.APPOINTMENTS} SELECT CAST(year(booked_at) AS INT) AS booked_year, {_MATURITY}, "
    f"{_rate('count(*) FILTER (mature AND completed)', 'count(*) FILTER (mature)', 'rate')} "
    "FROM appts GROUP BY 1",
)
def metric_completion(spark, sf):
    mart = marts.visit_cohort(appointments(spark, sf), []).withColumn(
        "booked_year", F.year("cohort_date")
    )
    rolled = marts.rollup(
        mart,
        ["booked_year"],
        ["mature", "mature_completed", "observing"],
        {"rate": ("mature_completed", "mature")},
    )
    return _rounded(rolled, "rate")


@query(
    "metric_started_completion",
    f"WITH {sql.APPOINTMENTS} SELECT count(*) FILTER (mature AND started) AS mature_started, "
    "count(*) FILTER (mature AND started AND completed) AS mature_started_completed, "
    + _rate(
        "count(*) FILTER (mature AND started AND completed)",
        "count(*) FILTER (mature AND started)",
        "rate",
    )
    + " FROM appts",
)
def metric_started_completion(spark, sf):
    mart = marts.visit_cohort(appointments(spark, sf), [])
    rolled = marts.rollup(
        mart,
        [],
        ["mature_started", "mature_started_completed"],
        {"rate": ("mature_started_completed", "mature_started")},
    )
    return _rounded(rolled, "rate")


@query(
    "metric_completed_visits",
    f"WITH {sql.APPOINTMENTS} SELECT CAST(CAST(scheduled + INTERVAL 30 MINUTE AS DATE) AS VARCHAR) "
    "AS completed_date, count(*) AS completed_visits FROM appts WHERE completed GROUP BY 1",
)
def metric_completed_visits(spark, sf):
    events = facts.visible(fx.appointment_events(spark, sf), as_of())
    done = marts.completed_visits(events)
    return done.withColumn("completed_date", F.col("completed_date").cast("string"))


@query(
    "mart_activity",
    f"WITH {sql.UNIQUE} SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS activity_date, "
    "customer_id, event_name, device_type, count(*) AS events FROM uniq "
    "WHERE customer_id IS NOT NULL GROUP BY 1, 2, 3, 4",
)
def mart_activity(spark, sf):
    mart = marts.customer_activity_daily(
        fx.unique_events(spark, sf), ["event_name", "device_type"]
    )
    return mart.withColumn("activity_date", F.col("activity_date").cast("string"))


@query(
    "active_customers",
    f"WITH {sql.UNIQUE} SELECT event_name, device_type, count(DISTINCT customer_id) AS active_customers "
    "FROM uniq WHERE customer_id IS NOT NULL AND CAST(event_time AS DATE) "
    "BETWEEN DATE '2024-01-05' AND DATE '2024-01-11' GROUP BY 1, 2",
)
def active_customers(spark, sf):
    """A week's distinct customers from the daily grain; daily numbers are never added up."""
    mart = marts.customer_activity_daily(
        fx.unique_events(spark, sf), ["event_name", "device_type"]
    )
    week = mart.where(F.col("activity_date").between("2024-01-05", "2024-01-11"))
    return marts.active_customers(week, ["event_name", "device_type"])


@query(
    "anonymous_visitors",
    f"WITH {sql.UNIQUE} SELECT device_type, count(DISTINCT anonymous_id) AS anonymous_visitors "
    "FROM uniq WHERE customer_id IS NULL AND anonymous_id IS NOT NULL GROUP BY 1",
)
def anonymous_visitors(spark, sf):
    return marts.anonymous_visitors(fx.unique_events(spark, sf), ["device_type"])


# A third of the failed connections counts as a completed visit and a third as a check-in, and some events name another
# customer, journey or appointment, so that every rule has offenders.
_VISITS = (
    "seen AS (SELECT * REPLACE (CASE WHEN event_name <> 'video_connection_failed' THEN event_name "
    "WHEN n % 3 = 0 THEN 'visit_completed' WHEN n % 3 = 1 THEN 'checkin_started' ELSE event_name END AS event_name, "
    "CASE WHEN n % 50 = 3 THEN customer_id || 'x' ELSE customer_id END AS customer_id, "
    "CASE WHEN n % 50 = 4 THEN booking_journey_id || 'x' ELSE booking_journey_id END AS booking_journey_id, "
    "CASE WHEN n % 50 = 8 THEN appointment_id || 'x' ELSE appointment_id END AS appointment_id) FROM uniq)"
)


def _many(column):
    return (
        f"SELECT count(*) AS n FROM (SELECT appointment_id FROM seen WHERE appointment_id IS NOT NULL "
        f"GROUP BY 1 HAVING count(DISTINCT {column}) > 1)"
    )


@query(
    "integrity_violations",
    f"WITH {sql.UNIQUE}, {_VISITS} SELECT 'many_customers' AS rule, n FROM ({_many('customer_id')}) "
    f"UNION ALL SELECT 'many_providers', n FROM ({_many('provider_id')}) "
    f"UNION ALL SELECT 'many_specialties', n FROM ({_many('specialty')}) "
    f"UNION ALL SELECT 'many_journeys', n FROM ({_many('booking_journey_id')}) "
    "UNION ALL SELECT 'many_completions', count(*) FROM (SELECT appointment_id FROM seen "
    "WHERE event_name = 'visit_completed' AND appointment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) "
    "UNION ALL SELECT 'many_appointments_per_journey', count(*) FROM (SELECT booking_journey_id "
    "FROM seen WHERE appointment_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT appointment_id) > 1) "
    "UNION ALL SELECT 'visit_in_booking_session', count(DISTINCT v.appointment_id) FROM seen v JOIN seen k "
    "ON v.appointment_id = k.appointment_id AND v.session_id = k.session_id AND k.event_name = 'appointment_booked' "
    "WHERE v.event_name IN ('visit_completed', 'checkin_started')",
)
def integrity_violations(spark, sf):
    number = F.floor(F.col("offset") / 2)
    name = F.col("event_name")
    visits = F.when(number % 3 == 0, "visit_completed").when(number % 3 == 1, "checkin_started").otherwise(name)

    def other(column, part):
        return F.when(number % 50 == part, F.concat(column, F.lit("x"))).otherwise(F.col(column))

    events = fx.unique_events(spark, sf).withColumns(
        {
            "event_name": F.when(name == "video_connection_failed", visits).otherwise(name),
            "customer_id": other("customer_id", 3),
            "booking_journey_id": other("booking_journey_id", 4),
            "appointment_id": other("appointment_id", 8),
        }
    )
    return facts.integrity_violations(events)
