"""Entity facts: one row per booking journey and per appointment.

A first aggregation keeps only minima and maxima per entity. It combines map-side, so an
entity with very many events stays a bounded row; times and counts keep it a hash
aggregation. Attribution columns come from a second one over the attribution events alone,
on the same key and so without another exchange. Ordered stages need one more look only
where the bounds leave the answer open; the bounds are stored once for those looks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustflow.functions.times import seconds
from trustflow.session import materialize

DAY_SECONDS = 24 * 3600


@dataclass(frozen=True)
class JourneySpec:
    """Stage event names of a booking journey."""

    key: str = "booking_journey_id"
    view: str = "provider_profile_viewed"
    slot: str = "appointment_slot_viewed"
    start: str = "booking_started"
    booked: str = "appointment_booked"
    dimensions: tuple[str, ...] = ("specialty", "device_type", "platform")
    time: str = "event_time"
    event_id: str = "event_id"
    name: str = "event_name"


@dataclass(frozen=True)
class AppointmentSpec:
    """Event names of an appointment's life."""

    key: str = "appointment_id"
    booked: str = "appointment_booked"
    started: str = "video_visit_started"
    completed: str = "visit_completed"
    failed: str = "video_connection_failed"
    dimensions: tuple[str, ...] = ("specialty", "device_type")
    scheduled: str = "scheduled_start_time"
    window_seconds: int = DAY_SECONDS


def _at(spec, name: str) -> Column:
    return F.when(F.col("event_name") == name, F.col("event_time"))


def first_touch(events: DataFrame, spec: JourneySpec, dimensions=None) -> DataFrame:
    """Attribution row per journey: the first view, ties broken by event id."""
    dims = list(dimensions or spec.dimensions)
    views = events.where((F.col(spec.name) == spec.view) & F.col(spec.key).isNotNull())
    row = F.struct(spec.time, spec.event_id, *dims)
    return (
        views.groupBy(spec.key)
        .agg(F.min(row).alias("first"))
        .select(spec.key, *[F.col(f"first.{c}").alias(c) for c in (spec.time, spec.event_id, *dims)])
    )


def _earliest_from(
    events: DataFrame, stages: DataFrame, spec: JourneySpec, stage: str, low: str, high: str, since: str
) -> DataFrame:
    """Adds ``<stage>_at``: the earliest stage event at or after the time in ``since``.

    Settled by the bounds for most journeys; only those whose stage events lie on both
    sides of ``since`` are looked up again.
    """
    name = {"started": spec.start, "booked": spec.booked}[stage]
    split = (F.col(low) < F.col(since)) & (F.col(high) >= F.col(since))
    unsettled = stages.where(split).select(spec.key, F.col(since).alias("_since"))
    found = (
        events.where(F.col(spec.name) == name)
        .select(spec.key, spec.time)
        .join(unsettled, spec.key)
        .where(F.col(spec.time) >= F.col("_since"))
        .groupBy(spec.key)
        .agg(F.min(spec.time).alias("_found"))
    )
    settled = F.when(F.col(low) >= F.col(since), F.col(low))
    return (
        stages.join(found, spec.key, "left")
        .withColumn(f"{stage}_at", F.coalesce(settled, F.col("_found")))
        .drop("_found")
    )


def journey_fact(events: DataFrame, spec: JourneySpec | None = None, dimensions=None) -> DataFrame:
    """Ordered stage times, attribution and instrumentation flags, one row per journey."""
    spec = spec or JourneySpec()
    dims = list(dimensions or spec.dimensions)
    rows = events.where(F.col(spec.key).isNotNull())
    bounds = rows.groupBy(spec.key).agg(
        F.count(F.lit(1)).alias("events"),
        F.min(_at(spec, spec.slot)).alias("_slot_low"),
        F.max(_at(spec, spec.slot)).alias("_slot_high"),
        F.min(_at(spec, spec.start)).alias("_start_low"),
        F.max(_at(spec, spec.start)).alias("_start_high"),
        F.min(_at(spec, spec.booked)).alias("_book_low"),
        F.max(_at(spec, spec.booked)).alias("_book_high"),
        F.count_if(
            ~F.col(spec.name).isin(spec.view, spec.slot, spec.start, spec.booked)
        ).alias("_later"),
    )
    touched = first_touch(rows, spec, dims).withColumnRenamed(spec.time, "viewed_at")
    bounds = materialize(bounds.join(touched.drop(spec.event_id), spec.key, "left"), "bounds")
    stages = _earliest_from(rows, bounds, spec, "started", "_start_low", "_start_high", "viewed_at")
    stages = materialize(stages, "stages")
    stages = _earliest_from(rows, stages, spec, "booked", "_book_low", "_book_high", "started_at")
    has_start, has_book = F.col("_start_low").isNotNull(), F.col("_book_low").isNotNull()
    viewed = F.col("viewed_at").isNotNull()
    incomplete = (
        (~viewed & (F.col("_slot_low").isNotNull() | has_start | has_book | (F.col("_later") > 0)))
        | (~has_start & (has_book | (F.col("_later") > 0)))
        | (~has_book & (F.col("_later") > 0))
    )
    return stages.select(
        spec.key,
        "viewed_at",
        "started_at",
        "booked_at",
        # Diagnostic stage, outside the headline funnel.
        (F.col("_slot_high") >= F.col("viewed_at")).alias("slot_after_view"),
        *dims,
        F.to_date("viewed_at").alias("cohort_date"),
        "events",
        incomplete.alias("incomplete_instrumentation"),
    )


def appointment_fact(
    events: DataFrame, as_of: Column, spec: AppointmentSpec | None = None
) -> DataFrame:
    """Outcome per appointment; dimensions come from the first booking event.

    An appointment whose visit events came without a booking is kept as incomplete instrumentation:
    its booking columns are NULL, its schedule is that of its other events.
    """
    spec = spec or AppointmentSpec()
    dims = list(spec.dimensions)
    rows = events.where(F.col(spec.key).isNotNull())
    carried = ("customer_id", "booking_journey_id", spec.scheduled, *dims)
    booking = (
        rows.where(F.col("event_name") == spec.booked)
        .groupBy(spec.key)
        .agg(F.min(F.struct("event_time", "event_id", *carried)).alias("b"))
        .select(
            spec.key,
            F.col("b.event_time").alias("booked_at"),
            *[F.col(f"b.{c}").alias(c) for c in carried],
        )
    )
    visits = rows.groupBy(spec.key).agg(
        F.min(_at(spec, spec.started)).alias("started_at"),
        F.min(_at(spec, spec.completed)).alias("completed_at"),
        F.count_if(F.col("event_name") == spec.failed).alias("connection_failures"),
        F.min(spec.scheduled).alias("_scheduled"),
    )
    joined = visits.join(booking, spec.key, "left").withColumn(
        spec.scheduled, F.coalesce(spec.scheduled, "_scheduled")
    )
    deadline = F.col(spec.scheduled) + seconds(spec.window_seconds)
    fact = joined.select(
        spec.key,
        "customer_id",
        "booking_journey_id",
        "booked_at",
        spec.scheduled,
        deadline.alias("observation_deadline"),
        "started_at",
        "completed_at",
        F.coalesce(as_of >= deadline, F.lit(False)).alias("mature"),
        F.col("booked_at").isNull().alias("incomplete_instrumentation"),
        F.col("started_at").isNotNull().alias("started"),
        (F.col("completed_at") <= deadline).alias("_in_window"),
        "connection_failures",
        *dims,
        F.to_date("booked_at").alias("cohort_date"),
    )
    completed = F.coalesce(F.col("_in_window"), F.lit(False))
    status = F.when(~F.col("mature"), "observing").when(completed, "completed").otherwise("incomplete")
    return fact.withColumn("completed", completed).withColumn("status", status).drop("_in_window")


def refresh_maturity(fact: DataFrame, as_of: Column) -> DataFrame:
    """Re-labels stored appointments as time passes, without reading events."""
    mature = as_of >= F.col("observation_deadline")
    status = F.when(~mature, "observing").when(F.col("completed"), "completed").otherwise("incomplete")
    return fact.withColumn("mature", mature).withColumn("status", status)


def visible(events: DataFrame, as_of: Column) -> DataFrame:
    """Events collected no later than the cut-off."""
    return events.where(F.col("received_at") <= as_of)


def integrity_violations(events: DataFrame, completed: str = "visit_completed") -> DataFrame:
    """Entity rules as counts of offending entities.

    Two values are told apart by min <> max, which needs one bounded row per entity instead
    of a set of distinct values.
    """

    def several(name: str) -> Column:
        return F.coalesce(F.min(name) != F.max(name), F.lit(False))

    ap = events.where("appointment_id IS NOT NULL")
    booking = F.col("event_name") == "appointment_booked"
    # Visit events start a new session: smallest and largest of each side are compared.
    visit = F.col("event_name").isin(
        "checkin_started", "waiting_room_entered", "video_visit_started", completed
    )
    per_appointment = ap.groupBy("appointment_id").agg(
        several("customer_id").alias("many_customers"),
        several("provider_id").alias("many_providers"),
        several("specialty").alias("many_specialties"),
        several("booking_journey_id").alias("many_journeys"),
        (F.count_if(F.col("event_name") == completed) > 1).alias("many_completions"),
    )
    sessions = (
        ap.where(booking | visit)
        .groupBy("appointment_id", "session_id")
        .agg(F.max(booking).alias("b"), F.max(visit).alias("v"))
        .where("b AND v")
        .select("appointment_id")
        .distinct()
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("visit_in_booking_session").alias("rule"), "n")
    )
    names = [
        "many_customers",
        "many_providers",
        "many_specialties",
        "many_journeys",
        "many_completions",
    ]
    flags = per_appointment.agg(*[F.count_if(n).alias(n) for n in names]).unpivot(
        [], names, "rule", "n"
    )
    journeys = (
        events.where("booking_journey_id IS NOT NULL AND appointment_id IS NOT NULL")
        .groupBy("booking_journey_id")
        .agg(several("appointment_id").alias("many"))
        .agg(F.count_if("many").alias("n"))
        .select(F.lit("many_appointments_per_journey").alias("rule"), "n")
    )
    return flags.unionByName(journeys).unionByName(sessions)
