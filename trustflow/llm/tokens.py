"""Token counts by separator scan over flat token files.

A flat token file is nothing but token ids of fixed width, each document closed by the end-of-document id; there is
no index. Files are cut into blocks of ``block_tokens`` ids. Each block is one read, searched
for the separator with one vector comparison, and gives a row per separator and one summary row (number of
separators, last separator). A prefix scan over the summaries of a file - running count and running last
separator - stitches the blocks: it numbers the documents and closes those that began in an earlier block.

``write`` makes such files from texts: one file per task in a shared folder (a new one after
``FILE_BYTES``), with a public tokenizer whose rank file is a parameter. Its result, kept as a table, says which
document stands at which place in which file; files of lost or repeated tasks are in no row of it.

Long runs of white space are cut by the same rule before the tokenizer's own pattern sees them, because its
look-ahead needs stack for each character of a run.

Defined results: null and empty texts have no tokens but their separator. Ids after the last separator are a document
that is not closed (``closed`` is false). Empty files and empty blocks have no documents. Repeated or null
document ids stay separate documents. A file whose size is not a whole number of ids is an error.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from trustflow.llm import store

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SEPARATOR = 50256  # the first id after the ranks
BLOCK_TOKENS = 8 << 20
FILE_BYTES = 1 << 30
TASK_BLOCKS = 16  # blocks that one task scans, where there are more than cores
#: Fixed value: how the tokenizer cuts text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fixed value: the tokenizer's white space, in runs long enough to be cut out.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")

PLACES = "file string, ordinal long, id long"


def encoding(ranks: bytes, pieces: str = PIECES) -> tiktoken.Encoding:
    table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("given", pat_str=pieces, mergeable_ranks=table, special_tokens={})


def encoder(ranks: bytes):
    """Text to ids, the same as the encoding's own for white space of any length.

    A run before other text is one piece without its last character, which begins the next piece; a run at the end is
    one piece."""
    given, whole = encoding(ranks), encoding(ranks, r"(?s).+")

    def encode(text: str) -> list[int]:
        ids, at = [], 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += given.encode_ordinary(text[at : run.start()])
            ids += whole.encode_ordinary(text[run.start() : end])
            at = end
        return ids + given.encode_ordinary(text[at:])

    return encode


def _write(folder: str, sent, separator: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        encode = encoder(sent.value)
        out, name, at, ordinal = None, "", 0, 0
        try:
            for batch in batches:
                ids, names, ordinals = batch.column(0), [], []
                for text in batch.column(1):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at, ordinal = f"{uuid.uuid4().hex}.tokens", 0, 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    data = np.array([*encode(text.as_py() or ""), separator], dtype=dtype).tobytes()
                    out.write(data)
                    names.append(name)
                    ordinals.append(ordinal)
                    at += len(data)
                    ordinal += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(ordinals, pa.int64()), ids], names=["file", "ordinal", "id"]
                )
        finally:
            if out is not None:
                out.close()

    return run


def write(documents: DataFrame, folder: str, tokenizer: str = TOKENIZER, separator: int = SEPARATOR, dtype: str = "<u2") -> DataFrame:
    """documents: (id, text). Writes flat token files; returns the stored places (file, ordinal, id)."""
    with open(tokenizer, "rb") as f:
        sent = documents.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary
    places = documents.mapInArrow(_write(store.uri(folder), sent, separator, dtype), PLACES)
    return store.keep(places, "token-places")


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes) of a folder; only names and sizes are read."""
    found = spark.read.format("binaryFile").load(folder).select("path", "length")
    return found.select(F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("bytes"))


def _scan(folder: str, separator: int, dtype: str):
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, block, first, count in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                with files.open_input_file(f"{root}/{file}") as f:
                    ids = np.frombuffer(f.read_at(count * width, first * width), dtype=dtype)
                at = np.flatnonzero(ids == separator) + first
                # A summary row (k = -1), then a row per separator; before is unknown for the first.
                last = int(at[-1]) if len(at) else None
                before = pa.array(np.concatenate([[0], at[:-1]]) if len(at) else at, pa.int64(), mask=np.arange(len(at)) < 1)
                n = len(at) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(np.arange(-1, n - 1)),
                        pa.concat_arrays([pa.array([last], pa.int64()), pa.array(at, pa.int64())]),
                        pa.concat_arrays([pa.array([len(at)], pa.int64()), before]),
                    ],
                    names=["file", "block", "k", "at", "before"],
                )

    return run


def counts(files: DataFrame, folder: str, separator: int = SEPARATOR, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """files: (file, bytes). One row per document: file, ordinal, first (its first id's place), n_tokens, closed."""
    width = np.dtype(dtype).itemsize
    whole = F.when(F.col("bytes") % width == 0, F.col("bytes")).otherwise(F.raise_error(F.concat(F.col("file"), F.lit(": not a whole number of ids"))).cast("long"))
    sized = files.filter("bytes > 0").select("file", F.floor(whole / width).alias("ids"))
    blocks = sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("ids") - 1) / block_tokens))))
    first = F.col("block") * block_tokens
    blocks = blocks.select("file", "block", first.alias("first"), F.least(F.lit(block_tokens), F.col("ids") - first).alias("count"))
    # Rows of a few bytes that stand for whole blocks: without a count adaptive execution would merge them into one task.
    spark = files.sparkSession
    n_blocks = blocks.count()
    tasks = max(1, min(n_blocks, max(spark.sparkContext.defaultParallelism, -(-n_blocks // TASK_BLOCKS))))
    found = blocks.repartition(tasks, "file", "block").mapInArrow(
        _scan(store.uri(folder), separator, dtype), "file string, block long, k long, at long, before long"
    )
    found = store.keep(found, "separators")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.filter("k = -1").select(
        "file", "block",
        F.coalesce(F.sum("before").over(earlier), F.lit(0)).alias("documents"),
        F.coalesce(F.max("at").over(earlier), F.lit(-1)).alias("last"),
    )
    closed = found.filter("k >= 0").join(store.keep(carried, "carried"), ["file", "block"]).select(
        "file", (F.col("documents") + F.col("k")).alias("ordinal"), (F.coalesce("before", "last") + 1).alias("first"), F.col("at").alias("end"), F.lit(True).alias("closed")
    )
    ends = found.filter("k = -1").groupBy("file").agg(F.sum("before").alias("ordinal"), (F.coalesce(F.max("at"), F.lit(-1)) + 1).alias("first"))
    tails = ends.join(sized.select("file", F.col("ids").alias("end")), "file").filter("end > first")
    rows = closed.union(tails.select("file", "ordinal", "first", "end", F.lit(False)))
    return rows.select("file", "ordinal", "first", (F.col("end") - F.col("first")).alias("n_tokens"), "closed")


def op4(spark, sf_dir: str) -> DataFrame:
    folder = store.new_path(spark, "tokens")
    places = write(store.table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    files = files_in(spark, folder).join(places.select("file").distinct(), "file")
    return counts(files, folder).join(places, ["file", "ordinal"]).select(F.col("id").alias("doc_id"), "n_tokens")
