"""Folding of progress reports, and schemas kept between micro-batches."""

import json

import pytest
from pyspark.sql import functions as F
from wire_helper import CONTRACT

from trustflow.operators import classify as ops
from trustflow.streaming import progress


def report(i, day=1):
    values = ("q", "run", "n", i, 10, "[]", "[]", None, i % 3, f"2025-01-{day:02d}T00:00:00.000Z")
    return json.dumps(dict(zip(progress.NAMES, values, strict=True))) + "\n"


def put(folder, numbers, day=1):
    for i in numbers:
        (folder / f"run-{i:09d}.json").write_text(report(i, day))


def sums(spark, folder):
    r = progress.dropped_by_watermark(spark, str(folder)).first()
    return (r.reports, r.dropped_by_watermark)


def files(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and not p.name.startswith((".", "_")))


def test_many_reports_in_few_files(spark, tmp_path):
    put(tmp_path, range(1000), 1)
    put(tmp_path, range(1000, 2000), 2)
    before = (2000, sum(i % 3 for i in range(2000)))
    assert sums(spark, tmp_path) == before
    assert progress.compact(spark, str(tmp_path), "p1") == 2000
    assert sums(spark, tmp_path) == before
    left = files(tmp_path)
    assert len(left) == 3 and not list(tmp_path.glob("run-*.json"))
    assert {"report_date=2025-01-01", "report_date=2025-01-02"} <= {p.name for p in (tmp_path / "_parts" / "p1").iterdir()}
    assert progress.compact(spark, str(tmp_path), "p2") == 0 and files(tmp_path) == left


def test_a_report_that_is_being_written_stays(spark, tmp_path):
    put(tmp_path, range(3))
    half = tmp_path / "run-000000003.json"
    half.write_text(report(3)[:-1])
    assert sums(spark, tmp_path) == (3, 3)
    assert progress.compact(spark, str(tmp_path), "p1") == 3
    assert half.exists() and sums(spark, tmp_path) == (3, 3)
    half.write_text(report(3))
    assert sums(spark, tmp_path) == (4, 3)
    assert progress.compact(spark, str(tmp_path), "p2") == 1 and sums(spark, tmp_path) == (4, 3)


def test_runs_that_died_lose_and_double_nothing(spark, tmp_path, monkeypatch):
    put(tmp_path, range(6))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(progress.store, "create_json", dies)
        with pytest.raises(OSError):
            progress.compact(spark, str(tmp_path), "p1")
    assert sums(spark, tmp_path) == (6, 6)
    with monkeypatch.context() as m:
        m.setattr(progress.store, "delete_all", dies)
        with pytest.raises(OSError):
            progress.compact(spark, str(tmp_path), "p1")
    assert sums(spark, tmp_path) == (6, 6)
    put(tmp_path, [6])
    assert progress.compact(spark, str(tmp_path), "p2") == 7
    assert sums(spark, tmp_path) == (7, 6) and not list(tmp_path.glob("run-*.json"))
    with pytest.raises(ValueError, match="already"):
        progress.compact(spark, str(tmp_path), "p2")


def test_parts_are_folded_into_one(spark, tmp_path):
    for k in range(progress.MAX_PARTS + 2):
        put(tmp_path, [k])
        progress.compact(spark, str(tmp_path), f"p{k}")
    n = progress.MAX_PARTS + 2
    assert sums(spark, tmp_path) == (n, sum(k % 3 for k in range(n)))
    assert len(list((tmp_path / "_parts").iterdir())) == 2


def test_known_schemas_need_no_second_read(spark, tmp_path, monkeypatch):
    passes, asked = [], []
    named = ops.named_schemas
    monkeypatch.setattr(ops, "named_schemas", lambda *a: passes.append(1) or named(*a))
    known = {1: CONTRACT.schema_json, 2: CONTRACT.schema_json}

    def lookup(i):
        asked.append(i)
        return known.get(i)

    cache, seen = ops.SchemaCache(lookup), []
    wire = spark.createDataFrame([(b"\0\0\0\0" + bytes([i]) + b"x", i) for i in (1, 2, 3)], "value binary, i int")

    def batch(*ids):
        rows = wire.where(F.col("i").isin(*ids))

        def action(catalog):
            held = {r.schema_id: r.schema_exists for r in catalog.collect()}
            if not set(ids) <= held.keys():
                raise RuntimeError(ops.UNRESOLVED + str(ids))
            seen.append(held)

        cache.run(rows, action)

    batch(1)
    batch(1)
    assert len(passes) == 1 and asked == [1]
    batch(1, 2)
    assert len(passes) == 2 and asked == [1, 2] and seen[-1] == {1: True, 2: True}
    batch(3)
    assert seen[-1][3] is False
    known[3] = CONTRACT.schema_json
    batch(3)
    assert seen[-1][3] is True and len(passes) == 3
    with pytest.raises(RuntimeError, match="other"):
        cache.run(wire, lambda _: (_ for _ in ()).throw(RuntimeError("other")))
