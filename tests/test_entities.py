"""Tables by entity: appends, replaced buckets, and facts rebuilt from touched buckets alone."""

import pytest
from pyspark.sql import functions as F

from trustflow.operators import facts as journey
from trustflow.plans import fixtures as fx
from trustflow.sources import entities, store

DDL = "id STRING, n INT"


def count_up(df):
    return df.groupBy("id").agg(F.count("*").alias("events"), F.sum("n").alias("total"))


def rows(spark, pairs):
    return spark.createDataFrame(pairs, DDL)


def held(table, spark):
    return sorted(map(tuple, table.read(spark).collect()), key=str)


def files(df):
    return set(df.inputFiles())


@pytest.fixture
def pair(spark, tmp_path):
    events = entities.EntityTable(str(tmp_path / "events"), "id", buckets=32)
    facts = entities.EntityTable(str(tmp_path / "facts"), "id", buckets=32)
    first = rows(spark, [(f"e{i % 300}", i) for i in range(900)])
    events.append(first, "load")
    facts.append(count_up(first), "load")
    return events, facts


def test_rebuild_equals_a_full_build_and_leaves_other_files(spark, pair):
    events, facts = pair
    before = files(facts.read(spark))
    late = rows(spark, [("e7", 1000), ("e7", 1001), ("new", 5)])
    touched = events.append(late, "late")
    replaced = entities.rebuild(events, facts, late, count_up, "late")
    assert replaced == touched and 0 < len(replaced) <= 2
    assert held(facts, spark) == sorted(map(tuple, count_up(events.read(spark)).collect()), key=str)
    after = files(facts.read(spark))
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in replaced}
    assert kept <= after and len(kept) == len(before) - len({f for f in before - after})
    assert files(events.read(spark, touched)) < files(events.read(spark))


def test_a_label_is_applied_once(spark, pair):
    events, facts = pair
    late = rows(spark, [("e1", 1)])
    for _ in range(2):
        events.append(late, "late")
        entities.rebuild(events, facts, late, count_up, "late")
    assert events.read(spark).count() == 901
    assert facts.read(spark).where("id = 'e1'").first().events == 4
    assert events.state(spark)["number"] == 2


def test_a_change_without_its_mark_is_invisible_and_run_again(spark, pair):
    events, _ = pair
    rows(spark, [("z", 1)]).withColumn("bucket", events.bucket()).write.partitionBy("bucket").parquet(f"{events.path}/data/died")
    assert events.read(spark).where("id = 'z'").count() == 0
    events.clear(spark)
    events.append(rows(spark, [("z", 2)]), "died")
    assert [r.n for r in events.read(spark).where("id = 'z'").collect()] == [2]


def test_of_two_writers_one_fails(spark, pair):
    events, _ = pair
    store.create_json(spark, f"{events.path}/marks/{2:012d}.json.tmp", {})  # not a mark of the next number
    store.delete(spark, f"{events.path}/marks/{2:012d}.json.tmp")
    state = events.state(spark)
    other = entities.EntityTable(events.path, "id", buckets=32)
    other.append(rows(spark, [("x", 1)]), "first")
    stale = type("Stale", (entities.EntityTable,), {"state": lambda self, spark: state})(events.path, "id", 32)
    with pytest.raises(Exception, match="already exists"):
        stale.append(rows(spark, [("y", 1)]), "second")
    assert {r.id for r in events.read(spark).where("id IN ('x', 'y')").collect()} == {"x"}


def test_entities_that_go_nulls_and_foreign_rows(spark, pair):
    events, facts = pair
    gone = rows(spark, [("e3", 0), (None, 0)])
    buckets = events.touched(gone.where("id IS NOT NULL"))
    events.replace(events.read(spark, buckets).where("id <> 'e3'"), buckets, "erase")
    entities.rebuild(events, facts, gone, count_up, "erase")
    assert facts.read(spark).where("id = 'e3'").count() == 0 and facts.read(spark).count() == 299
    events.append(rows(spark, [(None, 1)]), "nobody")
    assert events.read(spark).where("id IS NULL").count() == 1
    assert entities.rebuild(events, facts, rows(spark, [(None, 1)]), count_up, "nobody") == []
    with pytest.raises(ValueError, match="does not replace"):
        facts.replace(count_up(rows(spark, [("e1", 1), ("e2", 1), ("e4", 1)])), [], "foreign")
    other = entities.EntityTable(facts.path, "id", buckets=8)
    with pytest.raises(ValueError, match="laid out alike"):
        entities.rebuild(events, other, gone, count_up, "x")


def test_compaction_and_clearing_keep_the_rows(spark, pair):
    events, _ = pair
    for n in range(4):
        events.append(rows(spark, [("e1", n), ("e2", n)]), f"a{n}")
    want = held(events, spark)
    assert events.compact(spark, "fold", most=3) == events.touched(rows(spark, [("e1", 0), ("e2", 0)]))
    events.clear(spark)
    assert held(events, spark) == want and events.compact(spark, "again", most=3) == []
    assert set(store.data_files(spark, f"{events.path}/data")) == {"load", "fold"}


def test_journeys_by_touched_buckets(spark, sf_dir, tmp_path):
    """The journey fact over the given events, some of which come late."""
    key = "booking_journey_id"
    events = entities.EntityTable(str(tmp_path / "events"), key, buckets=64)
    facts = entities.EntityTable(str(tmp_path / "facts"), key, buckets=64)
    unique = fx.unique_events(spark, sf_dir)
    late = unique.where("pmod(xxhash64(event_id), 500) = 0")
    events.append(unique.join(late.select("event_id"), "event_id", "left_anti").select(*unique.columns), "load")
    facts.append(journey.journey_fact(events.read(spark)), "load")
    touched = events.append(late, "late")
    replaced = entities.rebuild(events, facts, late, journey.journey_fact, "late")
    assert set(replaced) <= set(touched)
    full = journey.journey_fact(unique)
    assert facts.read(spark).exceptAll(full).count() == 0 and full.exceptAll(facts.read(spark)).count() == 0
