"""Canonical event JSON, byte for byte as the standard library writes it."""

import datetime as dt
import json

from pyspark.sql import functions as F
from wire_helper import CONTRACT

from trustflow.functions.canonical import event_json, json_string

TEXTS = [
    "", "plain text ~!#[]^", 'quote " and back\\slash', "\b\f\n\r\t\x00\x1f\x7f\x80", "Zürich, größer", "Ελλάδα", "東京都", "Привет",
    "\U0001f600 and \U0001f1eb\U0001f1f7", "  ﻿￿", "\\u0041", "é" * 5000,
]


def test_escapes(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "i INT, t STRING")
    got = [r.j for r in df.select("i", json_string(F.col("t")).alias("j")).orderBy("i").collect()]
    assert got == [*map(json.dumps, TEXTS), None]


def test_events(spark):
    at = dt.datetime(2025, 3, 4, 9, 10, tzinfo=dt.timezone.utc)
    kinds = {f.name: f.kind for f in CONTRACT.fields}
    rows = []
    for n, text in enumerate([*TEXTS, None]):
        event = {f: text for f in kinds}
        event |= {f: at + dt.timedelta(microseconds=n) if n % 3 else None for f, k in kinds.items() if k == "timestamp"}
        rows.append(event | {f: n if n % 2 else None for f, k in kinds.items() if k == "int"})
    df = spark.createDataFrame([(i, e) for i, e in enumerate([*rows, None])], f"i INT, event {CONTRACT.spark_schema.simpleString()}")
    got = [r.j for r in df.select("i", event_json(F.col("event"), CONTRACT).alias("j")).orderBy("i").collect()]
    want = [json.dumps(e, default=lambda t: t.isoformat(), sort_keys=True) for e in rows]
    assert got == [*want, None]
