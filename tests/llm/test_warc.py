"""Archives: exact round trip, revisits, coalesced reads of a selection, and the files themselves."""

import base64
import glob
import gzip
import hashlib

from pyspark.sql import functions as F
from trustflow.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages():
    rows = [(i, f"http://x.org/{i}?a=é", f"<p>{i % 5} ü \r\n\r\n</p>" * (i % 7)) for i in range(60)]
    return [*rows, (900, None, None), (901, "http://n\r\nX: y", "WARC/1.1\r\n\r\n"), (None, "http://null", "<p>1 ü"), (None, None, rows[1][2]), (12, "again", rows[12][2]), (950, "http://long", "y" * 3_000_000)]


def plain(rows, least=0):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if same and len(body) >= least else None
        refers = first if first is not None and first != page_id else None
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(pages(), SCHEMA).repartition(3)
    folder = f"file://{tmp_path}/w"
    index = warc.write(df, folder)
    got = warc.read(index, folder).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == plain(pages())
    bodies = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response" and r.page_id is not None}
    for page_id, _, html in pages():
        if page_id in bodies:
            assert bodies[page_id] == (html or "").encode()
    assert {(r.page_id, r.url) for r in index.collect()} == {(p, u) for p, u, _ in pages()}
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/w/*.warc.gz"))
    assert data.count(b"WARC-Type: response\r\n") + data.count(b"WARC-Type: revisit\r\n") == len(pages())


def test_small_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame(pages(), SCHEMA)
    folder = str(tmp_path / "w")
    got = warc.read(warc.write(df, folder, min_revisit_bytes=20), folder, with_payload=False)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()], key=str) == plain(pages(), 20)


def test_a_selection_is_read_by_ranges(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(pages(), SCHEMA).coalesce(1)
    folder = str(tmp_path / "w")
    index = warc.write(df, folder)
    some = index.filter(F.col("page_id").isin(3, 4, 5, 40, 950))
    assert sorted(r.page_id for r in warc.read(some, folder).collect()) == [3, 4, 5, 40, 950]
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP_BYTES, 5), ("a", 10**9, 5), ("b", 0, warc.READ_BYTES), ("b", warc.READ_BYTES, 1)]
    assert [len(r) for r in warc._ranges(rows)] == [3, 1, 1, 1]


def test_empty_table(spark, tmp_path):
    index = warc.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert index.count() == 0
    assert warc.read(index, str(tmp_path / "w")).count() == 0
