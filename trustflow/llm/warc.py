"""WARC archives: written with an index, read back by coalesced byte ranges.

Index first: each writing task streams its records into an archive file of its own in a shared folder (one gzip
member per record, a new file after ``FILE_BYTES``) and returns, for each record, the file, offset, length, URL and
payload digest. The index is a table; a file counts only through it, so what a lost or
repeated task leaves behind is never read.

Reading takes any selection of index rows, sorts it by file and offset (range partitions, so one large
file is read by many tasks), joins ranges that lie at most ``GAP_BYTES`` apart into reads of at most
``READ_BYTES``, and parses and verifies the records.

Of pages with equal payloads (SHA-1 and length) of at least ``min_revisit_bytes``, that with the least
page_id is a response, the others are revisits that carry no payload. Only digests that occur more
than once are joined to the pages, so page bodies do not move when copies are few.

Defined results: a null payload is empty; a null URL is left out of the record. A page without an id is a revisit if
an equal payload has an id, and else a response; rows that repeat the least id are all responses. Line ends in
URLs are percent-encoded inside the archive; the index holds the URL as given. No pages give no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from trustflow.llm import store

FILE_BYTES = 1 << 30
GAP_BYTES = 1 << 16
READ_BYTES = 8 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
GZIP_WINDOW = 31

INDEX = "page_id long, file string, offset long, length long, url string, payload_digest string, record_type string"
RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _member(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    packer = zlib.compressobj(1, zlib.DEFLATED, GZIP_WINDOW)
    return packer.compress(VERSION + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>" if revisit else _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url and url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", _record_id(refers_to, digest) if revisit else None),
        ("X-Page-Id", page_id),
        ("X-Refers-To-Page-Id", refers_to),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    head = HTTP_HEAD.format(len(payload)).encode()
    return _member(fields, head if revisit else head + payload)


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k: v for k, _, v in (x.decode().partition(": ") for x in lines if x)}


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of the record, fields of its HTTP head, and its payload."""
    data = zlib.decompress(member, GZIP_WINDOW)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head.split(b"\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http.split(b"\r\n")[1:]), payload


def classified(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to (null for responses)."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumn("sha", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    groups = p.filter(F.col("bytes") >= min_revisit_bytes).groupBy("sha", "bytes")
    repeated = groups.agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1 AND first IS NOT NULL")
    repeated = store.keep(repeated.select("sha", "bytes", "first"), "repeated")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return p.join(repeated, ["sha", "bytes"], "left").select(
        "page_id", "url", "payload", F.when(other, F.col("first")).alias("refers_to")
    )


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                        info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    number, address, body, first = page_id.as_py(), url.as_py(), payload.as_py().encode(), refers_to.as_py()
                    digest = digest_of(body)
                    member = record(number, address, body, digest, first, date)
                    out.write(member)
                    rows.append((number, name, at, len(member), address, digest, "response" if first is None else "revisit"))
                    at += len(member)
                columns = zip(*rows, strict=True) if rows else [[]] * 7
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                names = ["page_id", "file", "offset", "length", "url", "payload_digest", "record_type"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        finally:
            if out is not None:
                out.close()

    return run


def write(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes pages (page_id, url, html) as archives into a folder that all executors reach, given as a path or
    URI of a file system that pyarrow knows. Returns the stored index."""
    records = classified(pages, min_revisit_bytes)
    return store.keep(records.mapInArrow(_write(store.uri(folder), date), INDEX), "warc-index")


def _ranges(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Runs of sorted (file, offset, length) that one read fetches."""
    run: list[tuple[str, int, int]] = []
    for row in rows:
        if run:
            file, start, end = run[0][0], run[0][1], run[-1][1] + run[-1][2]
            if row[0] != file or row[1] - end > GAP_BYTES or row[1] + row[2] - start > READ_BYTES:
                yield run
                run = []
        run.append(row)
    if run:
        yield run


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            for reads in _ranges(rows):
                if name != reads[0][0]:
                    name = reads[0][0]
                    source = files.open_input_file(f"{root}/{name}")
                start, end = reads[0][1], reads[-1][1] + reads[-1][2]
                data = source.read_at(end - start, start)
                out: dict[str, list] = {k.split()[0]: [] for k in RECORDS.split(", ")}
                bodies = []
                for _, offset, length in reads:
                    fields, http, payload = parse(data[offset - start : offset - start + length])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and digest_of(payload) != digest:
                        raise ValueError(f"{name} at {offset}: the payload does not match its digest")
                    refers = fields.get("X-Refers-To-Page-Id")
                    page = fields.get("X-Page-Id")
                    out["page_id"].append(page and int(page))
                    out["url"].append(fields.get("WARC-Target-URI"))
                    out["record_type"].append(kind)
                    out["payload_digest"].append(digest)
                    out["payload_bytes"].append(int(http["Content-Length"]))
                    out["refers_to"].append(refers and int(refers))
                    bodies.append(payload if kind == "response" else None)
                types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
                arrays = [pa.array(v, types.get(k, pa.string())) for k, v in out.items()]
                names = list(out)
                if with_payload:
                    arrays, names = [*arrays, pa.array(bodies, pa.binary())], [*names, "payload"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def read(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows, whatever selection that is; payload is null for revisits."""
    places = index.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInArrow(_read(store.uri(folder), with_payload), RECORDS + ", payload binary" * with_payload)


def op1(spark, sf_dir: str) -> DataFrame:
    folder = store.new_path(spark, "warc")
    index = write(store.table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return read(index, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
