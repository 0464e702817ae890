"""Physical plans: what must not shuffle, what must be pushed down, what must combine early."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from trustflow.operators import classify, dedup, facts, reconcile, rules
from trustflow.plans import catalog
from trustflow.plans import fixtures as fx


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_classification_is_map_only_with_one_decode(spark, sf_dir):
    text = plan(fx.classified(spark, sf_dir))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert len(re.findall(r"^\(\d+\) ArrowEvalPython", text, re.M)) == 1
    # The only exchanges serve the one-row-per-schema catalog.
    assert "hashpartitioning" not in text and "rangepartitioning" not in text


def decodes(text: str) -> int:
    return len(re.findall(r"^\(\d+\) ArrowEvalPython", text, re.M))


def test_filters_on_the_outcome_do_not_decode_twice(spark, sf_dir):
    valid = fx.valid(spark, sf_dir)
    assert decodes(plan(valid)) == 1
    assert decodes(plan(fx.classified(spark, sf_dir).where("event IS NOT NULL"))) == 1
    flat = classify.decode_flatten(fx.deliveries(spark, sf_dir), 1, fx.CONTRACT)
    assert decodes(plan(flat.where("event_name = 'booking_started'"))) == 1


def test_closed_ranges_prune_the_classified_table(spark, sf_dir):
    for name in ("recon_missing_events", "recon_ingest_window", "throughput_5min", "invalid_rate"):
        text = plan(catalog.QUERIES[name](spark, sf_dir))
        assert re.search(r"PartitionFilters: \[[^\]]*ingest_date", text), name
        assert decodes(text) == 0, name
    assert decodes(plan(catalog.QUERIES["view_disjointness"](spark, sf_dir))) == 0


def test_delivery_filter_passes_the_decoder(spark, sf_dir):
    window = fx.valid(spark, sf_dir).where("partition = 2")
    text = plan(window)
    assert decodes(text) == 1 and "EqualTo(partition,2)" in text


def test_route_counts_read_only_the_value(spark, sf_dir):
    text = plan(fx.classified(spark, sf_dir).groupBy("route").count())
    assert re.search(r"ReadSchema: struct<value:binary>", text)


def test_coordinate_filter_reaches_the_scan(spark, sf_dir):
    rows = fx.deliveries(spark, sf_dir).where("partition = 1 AND offset = 10")
    assert "EqualTo(offset,10)" in plan(rows)


def test_rules_run_without_python(spark, sf_dir):
    checked = fx.ev(spark, sf_dir).select(rules.codes(fx.CONTRACT).alias("c"))
    text = plan(checked)
    # The one exchange is the fixture's own spreading of the given file.
    assert "Python" not in text and text.count("hashpartitioning") == text.count("REPARTITION_BY_COL")


def test_dedup_limits_groups_before_the_shuffle(spark, sf_dir):
    text = plan(dedup.first_delivery(fx.valid(spark, sf_dir)))
    partial, exchange = text.index("WindowGroupLimit"), text.index("Exchange")
    assert text.count("WindowGroupLimit") >= 2 and partial < text.rindex("WindowGroupLimit")
    assert exchange > 0


def test_journey_fact_shuffles_on_the_entity_only(spark, sf_dir):
    text = plan(facts.journey_fact(fx.unique_events(spark, sf_dir)))
    keys = set(re.findall(r"hashpartitioning\((\w+)#", text))
    assert keys == {"booking_journey_id"}
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_missing_events_project_the_key(spark, sf_dir):
    valid = fx.unique_events(spark, sf_dir)
    text = plan(reconcile.missing_events(valid.select("event_id"), valid))
    assert "LeftAnti" in text and "ReadSchema: struct<event_id:string>" in text


def test_hot_journey_gives_the_same_fact(spark):
    """Half of all events in one journey, stages out of order: equal to a direct search."""
    rows = []
    for i in range(2000):
        name = ("booking_started", "provider_profile_viewed", "appointment_booked")[i % 3]
        journey = "hot" if i % 2 else f"j{i % 37}"
        rows.append((f"e{i}", journey, name, (i * 7919) % 100_000, "s", "d", "p"))
    events = spark.createDataFrame(
        rows, "event_id STRING, booking_journey_id STRING, event_name STRING, s LONG, "
        "specialty STRING, device_type STRING, platform STRING"
    ).withColumn("event_time", F.timestamp_seconds("s"))
    want = {}
    for journey in {r[1] for r in rows}:
        at = {n: sorted(r[3] for r in rows if r[1] == journey and r[2] == n) for n in {r[2] for r in rows}}
        v = min(at["provider_profile_viewed"], default=None)
        s = next((x for x in at["booking_started"] if v is not None and x >= v), None)
        b = next((x for x in at["appointment_booked"] if s is not None and x >= s), None)
        want[journey] = (v, s, b)
    fact = facts.journey_fact(events).select(
        "booking_journey_id",
        *[F.unix_seconds(c) for c in ("viewed_at", "started_at", "booked_at")],
    )
    assert {r[0]: tuple(r[1:]) for r in fact.collect()} == want


def test_tasks_grow_with_the_rows_and_their_share_does_not(spark, sf_dir, monkeypatch):
    """Where derived tables are written, and where stored ones are read or shuffled, the share of a task is bounded."""
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    rows = fx.deliveries(spark, sf_dir)
    assert fx.tasks_for(rows) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(fx, "TASK_ROWS", 100)
    count = rows.count()
    assert fx.tasks_for(rows) == -(-count // 100)
    parts = fx.derive_classified(spark, sf_dir).select(F.spark_partition_id().alias("p"), "ingest_date")
    per_task = parts.groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("ingest_date").alias("days")).collect()
    assert sum(r.n for r in per_task) == count and len(per_task) > count // 200
    assert max(r.n for r in per_task) <= 300 and max(r.days for r in per_task) <= 6
