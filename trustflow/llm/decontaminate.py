"""Benchmark passages in documents, found by Wu-Manber search over words.

Text is taken as words: A-Z in lower case, then runs of ``0-9``, ``a-z`` and every character
above 0x7F. Each benchmark item gives windows of ``window`` consecutive words; an item of fewer
words, but not none, is one window of its own length. The windows of one length form one search
table. Its blocks are pairs of words (single words for windows of one word):

- the shift table says, for a block that ends at the current position, how far the search may
  move on without passing over any window; blocks that occur in no window allow the longest move;
- a block that ends some window selects, by the hash of that window's last words, a bucket of
  windows;
- each window of the bucket is compared word by word.

The benchmark is a query set held against all documents. It is cut by item into blocks of a
bounded number of characters; each block is one table that is sent to the executors, and the
documents pass all blocks in turn, so neither the driver nor a task ever holds more than one
block of it. Hits of several blocks are united before words are counted.

Defined results: null texts and texts without words have no words, no hits and no items. Items
without words have no windows. An item whose id is null still marks words but is not listed.
Repeated item ids are listed once. Benchmark or documents may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trustflow.llm import store

WINDOW = 13
BLOCK_CHARS = 2_000_000
CONTAMINATED_SHARE = 20  # contaminated from one word in twenty on

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class WindowTable:
    """Search table for windows of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict[int, dict[tuple, list[int]]] = {}

    def add(self, window: tuple, item: int) -> None:
        for end in range(self.block, self.length + 1):
            key = window[end - self.block : end]
            move = self.length - end
            if move < self.shift.get(key, self.longest):
                self.shift[key] = move
        bucket = self.buckets.setdefault(hash(window[-self.block - 1 :]), {})
        items = bucket.setdefault(window, [])
        if not items or items[-1] != item:
            items.append(item)

    def search(self, words: list[bytes], spans: list[tuple[int, int]], items: set[int]) -> None:
        shift, buckets, longest = self.shift.get, self.buckets.get, self.longest
        n, m, block = len(words), self.length, self.block
        end = m
        while end <= n:
            move = shift((words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],), longest)
            if move:
                end += move
                continue
            bucket = buckets(hash(tuple(words[max(end - m, end - block - 1) : end])))
            if bucket is not None:
                found = bucket.get(tuple(words[end - m : end]))
                if found is not None:
                    spans.append((end - m, end))
                    items.update(found)
            end += 1


def tables_for(rows: list[tuple], window: int) -> list[WindowTable]:
    """rows: (number, text). One table for each length of window that occurs."""
    tables: dict[int, WindowTable] = {}
    for number, text in rows:
        words = words_of(text)
        length = min(window, len(words))
        if length:
            table = tables.setdefault(length, WindowTable(length))
            for i in range(len(words) - length + 1):
                table.add(tuple(words[i : i + length]), number)
    return list(tables.values())


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _scan(sent, text_col: str, window: int):
    """One pass over the documents with one block of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tables = sent.value["ids"], tables_for(sent.value["rows"], window)
        for batch in batches:
            row, before, seen = batch.column("row"), batch.column("spans"), batch.column("items")
            all_spans, all_items, counts = [], [], []
            for text, old, listed in zip(row.field(text_col), before, seen, strict=True):
                words = words_of(text.as_py())
                spans: list[tuple[int, int]] = []
                found: set[int] = set()
                for t in tables:
                    t.search(words, spans, found)
                flat = old.as_py() or []
                spans += zip(flat[::2], flat[1::2], strict=True)
                all_spans.append([x for s in united(spans) for x in s])
                all_items.append(sorted({*(listed.as_py() or []), *(ids[i] for i in found if ids[i] is not None)}))
                counts.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(counts, pa.int64()), pa.array(all_spans, pa.list_(pa.int32())), pa.array(all_items, pa.list_(pa.string()))],
                names=["row", "n_words", "spans", "items"],
            )

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about block_chars characters. Items fall into hash parts of about a
    quarter block; the sizes of the parts say which parts make a block, and one block is fetched at a time."""
    texts = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter(
        F.length("text") > 0
    )
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n_parts = 1 + 4 * chars // block_chars
    rows = texts.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(n_parts)))
    sizes = {r.part: r.chars for r in rows.groupBy("part").agg(F.sum(F.length("text")).alias("chars")).collect()}
    chosen: list[int] = []
    for part in sorted(sizes):
        if chosen and sum(sizes[p] for p in chosen) + sizes[part] > block_chars:
            yield rows.filter(F.col("part").isin(chosen)).select("id", "text").collect()
            chosen = []
        chosen.append(part)
    yield rows.filter(F.col("part").isin(chosen)).select("id", "text").collect() if chosen else []


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """For each document row: ``row`` (the input row as a struct), n_words, ``spans`` (start and end
    of each hit stretch of words, in turn) and ``items`` (ids as strings, sorted)."""
    spark = documents.sparkSession
    spans, items = T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType())
    out = documents.select(
        F.struct("*").alias("row"), F.lit(None).cast(spans).alias("spans"), F.lit(None).cast(items).alias("items")
    )
    schema = T.StructType(
        [out.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("spans", spans), T.StructField("items", items)]
    )
    for rows in _blocks(benchmark, item_col, item_text_col, block_chars):
        sent = spark.sparkContext.broadcast(
            {"ids": [r.id for r in rows], "rows": [(i, r.text) for i, r in enumerate(rows)]}
        )
        out = out.select("row", "spans", "items").mapInArrow(_scan(sent, text_col, window), schema)
    return out


def report(documents: DataFrame, benchmark: DataFrame, share: int = CONTAMINATED_SHARE, **options) -> DataFrame:
    """``row`` of each document with n_words, n_hit, n_items, items_sha256 and contaminated."""
    n_hit = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign")),
        lambda a, x: F.struct((a["sum"] + a["sign"] * x).alias("sum"), (-a["sign"]).alias("sign")),
        lambda a: a["sum"],
    )
    found = matches(documents, benchmark, **options).select("row", "n_words", n_hit.alias("n_hit"), "items")
    return found.select(
        "row", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return report(documents, benchmark, **options).filter(~F.col("contaminated")).select("row.*")


def op10(spark, sf_dir: str) -> DataFrame:
    documents = store.table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = report(documents, store.table(spark, sf_dir, "benchmark"))
    return judged.select(F.col("row.doc_id").alias("doc_id"), *judged.columns[1:])
