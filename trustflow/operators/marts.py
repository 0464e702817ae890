"""Marts and metrics. Rates always come from stored counts; a zero denominator gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: str, denominator: str) -> Column:
    return F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))


def _counted(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def booking_funnel(journeys: DataFrame, dimensions) -> DataFrame:
    """Counts per stage by cohort day and dimensions; cohorts need a first view."""
    return (
        journeys.where("viewed_at IS NOT NULL")
        .groupBy("cohort_date", *dimensions)
        .agg(
            F.count(F.lit(1)).alias("viewed"),
            F.count("started_at").alias("started"),
            F.count("booked_at").alias("booked"),
            _counted(F.col("slot_after_view"), "slot_viewed"),
            _counted(F.col("incomplete_instrumentation"), "incomplete"),
        )
    )


def visit_cohort(appointments: DataFrame, dimensions) -> DataFrame:
    """Outcomes by booking day; appointments without a booking belong to no cohort."""
    mature = F.col("mature")
    in_day_of_start = F.unix_micros("completed_at") <= F.unix_micros("started_at") + F.lit(
        86_400_000_000
    )
    return appointments.where("booked_at IS NOT NULL").groupBy("cohort_date", *dimensions).agg(
        F.count(F.lit(1)).alias("booked"),
        _counted(mature, "mature"),
        _counted(mature & F.col("completed"), "mature_completed"),
        _counted(mature & F.col("started"), "mature_started"),
        _counted(mature & F.col("started") & in_day_of_start, "mature_started_completed"),
        _counted(~mature, "observing"),
    )


def customer_activity_daily(events: DataFrame, dimensions) -> DataFrame:
    """Day x customer x dimensions, so distinct customers can be counted after any filter."""
    return (
        events.where("customer_id IS NOT NULL")
        .groupBy(F.to_date("event_time").alias("activity_date"), "customer_id", *dimensions)
        .agg(F.count(F.lit(1)).alias("events"))
    )


def active_customers(activity: DataFrame, by=()) -> DataFrame:
    """Distinct customers after filters. Two steps, so no task holds all customers of a group."""
    distinct = activity.select(*by, "customer_id").distinct()
    return distinct.groupBy(*by).agg(F.count(F.lit(1)).alias("active_customers"))


def anonymous_visitors(events: DataFrame, by=()) -> DataFrame:
    rows = events.where("customer_id IS NULL AND anonymous_id IS NOT NULL")
    distinct = rows.select(*by, "anonymous_id").distinct()
    return distinct.groupBy(*by).agg(F.count(F.lit(1)).alias("anonymous_visitors"))


def rollup(mart: DataFrame, by, counts, rates: dict[str, tuple[str, str]]) -> DataFrame:
    """Coarser rows with rates recomputed from summed counts."""
    summed = mart.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    return summed.select("*", *[ratio(n, d).alias(r) for r, (n, d) in rates.items()])


def step_rates(funnel: DataFrame, by=()) -> DataFrame:
    """Step conversion and drop-off between consecutive stages."""
    stages = ("viewed", "started", "booked")
    summed = funnel.groupBy(*by).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stages])
    pairs = list(zip(stages, stages[1:]))
    steps = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f"{a}_to_{b}").alias("step"),
                    F.col(a).alias("current"),
                    F.col(b).alias("next"),
                )
                for a, b in pairs
            ]
        )
    )
    rows = summed.select(*by, steps.alias("s")).select(*by, "s.*")
    conversion = ratio("next", "current")
    return rows.select("*", conversion.alias("conversion"), (1 - conversion).alias("drop_off"))


def completed_visits(events: DataFrame, completed: str = "visit_completed") -> DataFrame:
    """Distinct completed appointments by completion day."""
    done = events.where(F.col("event_name") == completed)
    distinct = done.select(F.to_date("event_time").alias("completed_date"), "appointment_id").distinct()
    return distinct.groupBy("completed_date").agg(F.count(F.lit(1)).alias("completed_visits"))
