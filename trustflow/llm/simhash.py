"""SimHash near copies by multi-index hashing.

Fingerprint: A-Z in lower case, words ``[^\\x20\\x09-\\x0D]+``, shingles of three words (repeats
count; a text of fewer words is one shingle; no words give fingerprint zero), XXH64 with seed 42
of each shingle's UTF-8 bytes. A bit is 1 if it is set in over half the hashes.

Links: two fingerprints that differ in at most two bits. The 64 bits are two segments of 32. Each
distinct fingerprint enters the index under every member of the radius-1 Hamming ball of each
segment, the other segment kept: 1 + 32 + 32 entries. Two fingerprints within two bits differ by two
bits in one segment, where their balls meet half way, or by one bit in each, where one's ball in the
first segment meets the other's ball in the second; so they share an entry. As the entry
holds both segments, it has at most 65 fingerprints however many near copies share a segment. The members of
an entry are linked in a row, each to the one before, after their whole distance has been verified;
pairs that are left out are joined through the row, so components are whole and no entry makes all pairs.

Exact copies are merged before the index is built and meet only in sums and in the final lookup.

Defined results: null and empty texts have fingerprint zero and link like any other. A repeated
doc_id gives a row each time. component_id is the least doc_id of the component; it is null only
where all its documents have a null doc_id. The empty table gives the empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from trustflow.llm import nearcopies, store
from trustflow.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 2
SEGMENTS = ((0, 32), (32, 64))  # bit ranges
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, width: int = SHINGLE_WORDS) -> int:
    """As an unsigned number. bytes.lower() and bytes.split() know ASCII only, as the definition asks."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    shingles = map(join, zip(*(words[i:] for i in range(width)), strict=False)) if n > 1 or len(words) == width else [join(words)]
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _CHUNK):
        bits = np.unpackbits(hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _mark(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            texts = row.field(text_col).cast(pa.binary())
            marks = np.fromiter((fingerprint(t.as_py()) for t in texts), dtype="<u8", count=len(row))
            yield pa.RecordBatch.from_arrays([row, pa.array(marks.view("<i8"))], names=["row", "fp"])

    return run


def fingerprints(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the input row as a struct) and ``fp`` (the 64 bits as a signed long)."""
    rows = documents.select(F.struct("*").alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("fp", T.LongType(), False)])
    return rows.mapInArrow(_mark(text_col), schema)


def index_entries(distinct: DataFrame) -> DataFrame:
    """(fp) -> (entry, bit): the ball members, bit -1 for the fingerprint itself."""
    ball = F.transform(
        F.expr("sequence(-1, 63)"),
        lambda i: F.struct(
            F.when(i < 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("entry"),
            i.cast("byte").alias("bit"),
        ),
    )
    return distinct.select(F.inline(ball))


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between fingerprints of distinct rows (fp), enough to hold every component together."""
    if distance != 2:
        raise ValueError("balls of radius one in each segment find distances up to two")
    one = F.lit(1).cast("long")
    entries = index_entries(distinct)
    before = F.lag("bit").over(Window.partitionBy("entry").orderBy("bit"))

    def restored(bit):
        return F.when(bit < 0, F.col("entry")).otherwise(F.col("entry").bitwiseXOR(F.call_function("shiftleft", one, bit.cast("int"))))

    pairs = entries.select("entry", "bit", before.alias("other")).filter("other IS NOT NULL")
    pairs = pairs.select(restored(F.col("other")).alias("a"), restored(F.col("bit")).alias("b"))
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()


def groups(marked: DataFrame, id_col: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """marked: stored rows with id_col and fp. Returns one row per distinct fingerprint:
    (fp, label, component_id); label is the component's least fingerprint."""
    nodes = store.keep(marked.groupBy("fp").agg(F.min(id_col).alias("least_id")), "fingerprints")
    linked = components(links(nodes.select("fp"), distance)).select(F.col("node").alias("fp"), "label")
    linked = store.keep(linked.join(nodes, "fp"), "linked")
    least = linked.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of = linked.join(least, "label").select("fp", "label", "component_id")
    return nodes.join(of, "fp", "left").select(
        "fp",
        F.coalesce("label", "fp").alias("label"),
        F.when(F.col("label").isNotNull(), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id"),
    )


def candidates(nodes: DataFrame) -> DataFrame:
    """nodes: stored (node, fp). Pairs (a, b), a < b, of nodes whose fingerprints link: those of one fingerprint
    in a row, and the first ones of two fingerprints that ``links`` finds."""
    row = nodes.select("node", F.lag("node").over(Window.partitionBy("fp").orderBy("node")).alias("other")).filter("other IS NOT NULL")
    first = store.keep(nodes.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    near = store.keep(links(first.select("fp")), "fingerprint-links")
    ends = near.join(first.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a").join(
        first.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b"
    )
    pairs = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return row.select(F.col("other").alias("a"), F.col("node").alias("b")).union(pairs).distinct()


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near copies (similarity of 0.8 over five words): of each component the row with the least id (null
    ids last; repeated ids by a hash of the text). Fingerprints over five words are indexed and linked as
    above and their pairs verified on the texts; as two bits reach hardly more than exact copies, ``nearcopies`` finds the pairs
    beyond them. Texts move when candidates are compared and when the kept rows are picked out."""
    rows = documents.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid"))
    marked = store.keep(rows, "marked")
    text = F.col(f"row.{text_col}")
    slim = store.keep(
        nearcopies.signed(marked.select("rid", F.col(f"row.{id_col}").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text")), fingerprint), "slim"
    )
    labelled = slim.join(nearcopies.groups(slim, marked.select("rid", text.alias("text")), candidates=candidates), "key")
    first = F.row_number().over(Window.partitionBy("label").orderBy(F.col("id").asc_nulls_last(), "tie", "rid"))
    winners = store.keep(labelled.select("rid", first.alias("n")).filter("n = 1").select("rid"), "kept")
    # One plan at every size: without the hint a short list of winners would be broadcast and a long one not.
    return marked.join(winners.hint("merge"), "rid", "left_semi").select("row.*")


def op5(spark, sf_dir: str) -> DataFrame:
    documents = store.table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = store.keep(fingerprints(documents).select("row.doc_id", "fp"), "marked")
    return marked.join(groups(marked), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
