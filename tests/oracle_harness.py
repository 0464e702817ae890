"""Runs a registered query and its SQL twin and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v) if v % 1 else int(v)
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6f}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows])


def compare(spark, con, sf_dir, name, query, sql):
    start = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    if sql is None:
        return len(rows), took, None, dict(df.dtypes)
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return len(rows), took, f"columns {sorted(df.columns)} != {sorted(want_columns)}", None
    got_n, want_n = normal(df.columns, rows), normal(want_columns, want)
    if got_n != want_n:
        extra = [r for r in got_n if r not in set(want_n)][:3]
        lost = [r for r in want_n if r not in set(got_n)][:3]
        return len(rows), took, f"{len(got_n)} vs {len(want_n)} rows; extra {extra}; lost {lost}", None
    return len(rows), took, None, {"spark": dict(df.dtypes), "duck": want_types}
