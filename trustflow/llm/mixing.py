"""Mixing sources to target weights, by fixed-length blocks of words.

1. Layout. The documents of a source stand in a pseudorandom order, one after the other, and are cut into
   blocks of ``block_words`` words (a block may cross documents; the last of a source may be short).
   The order is kept in buckets of about ``BUCKET_ROWS`` documents with a running total over the
   buckets, so a large source is many small windows.
2. Targets. Sources in code-point order, null last, have the given weights in turn and share all words by
   weight; no target is above ``repeats`` times its source, and what is over goes to the others by weight.
   With the sources sorted by limit over weight this is one pass of running totals.
3. Draws. Each output shard of ``shard_slots`` slots draws the counts of its sources from a multinomial
   distribution, seeded by shard. Slots beyond a source's quota are handed, in order, to the
   sources that fell short, so totals meet the quotas and only that part departs from the draw.
4. Slots. The n-th slot of a source is the n-th block of a pseudorandom permutation of its
   block numbers (Feistel network with cycle walking), a new permutation for each pass. A block is
   thus never used a further time before all others of its source have been.
5. Blocks and slots are joined by source and block number, before any text moves: each document gets the list of its
   blocks and their slots. ``write_mix`` then reads the texts, cuts them into the stretches of their blocks and puts these together,
   slot by slot, as the mixed text. A text is moved twice, compressed: to its place in the source and to its shards; it is
   stored only in these. ``mix`` only needs to know how many words are taken of each document, so it joins
   the lengths of the same stretches and moves no text. Both give the same counts.

Defined results: null and empty texts have size 0 and nothing is taken of them. Null is a source of its
own. Repeated rows are separate documents. All draws are functions of the data and the seed, so reruns agree,
however the rows are partitioned. Without any words every target is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trustflow.llm import store

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 128
SHARD_SLOTS = 1 << 16
BUCKET_ROWS = 1000
SEED = 6
WORD = r"[^\x20\x09-\x0D]+"
HELD_BYTES = 1 << 23
#: Both sides of the join of texts lie by source and bucket already; by default Spark would deal them anew by all keys of the join. Batches of
#: texts and chunks are bounded by bytes, as their rows are large.
WRITE_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _scramble(x: np.ndarray, key: int) -> np.ndarray:
    """64 bits to 64 bits (the finaliser of SplitMix64 over the keyed value)."""
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, *key: int) -> np.ndarray:
    """The pseudorandom permutation of 0 .. size - 1 that the key names, at the given places."""
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    rounds = np.random.SeedSequence(key).generate_state(4, np.uint64)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        left, right = out[todo] >> half, out[todo] & mask
        for r in rounds:
            left, right = right, left ^ (_scramble(right, int(r)) & mask)
        out[todo] = (left << half) | right
        todo &= out >= size
    return out.astype(np.int64)


def sized(documents: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``row`` with size, source and a hash of the text."""
    return documents.select(
        F.struct("*").alias("row"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(source_col).alias("source"), F.xxhash64(text_col).alias("text_hash"),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """sizes: rows (source, size). One row per source: source_no, source_size, target, n_blocks and quota (slots)."""
    one = Window.partitionBy(F.lit(1))  # one row per source
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    s = s.withColumn("source_no", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumn("weight", F.element_at(F.lit(list(weights)), F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("double"))
    s = s.withColumn("limit", F.lit(float(repeats)) * F.col("source_size")).withColumn("all", F.sum("source_size").over(one).cast("double"))
    rise = one.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before, on = rise.rowsBetween(Window.unboundedPreceding, -1), rise.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("all") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(on)
    s = s.withColumn("full", F.col("limit") <= F.col("weight") * level)
    left = F.col("all") - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(one), F.lit(0.0))
    share = left / F.sum(F.when(~F.col("full"), F.col("weight"))).over(one)
    s = s.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * share))
    s = s.withColumn("n_blocks", F.ceil(F.col("source_size") / block_words))
    slots = F.round(F.col("target") * F.col("n_blocks") / F.nullif("source_size", F.lit(0))).cast("long")
    quota = F.coalesce(F.least(slots, F.col("n_blocks") * repeats), F.lit(0))
    return s.select("source", "source_no", "source_size", "n_docs", "target", "n_blocks", quota.alias("quota"))


def bucketed(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs: id, text_hash, size, source_no, n_docs, and rid where rows have one. Adds ``bucket`` and ``ahead``: the words of the
    bucket before the document. Rows that agree in all of these but rid may stand for each other."""
    place = F.xxhash64("id", "text_hash")
    docs = docs.withColumn("place", place).withColumn("bucket", F.pmod(place, F.ceil(F.col("n_docs") / bucket_rows)))
    order = ["place", "id", "text_hash", "size", *(["rid"] if "rid" in docs.columns else [])]
    within = Window.partitionBy("source_no", "bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return docs.drop("n_docs").withColumn("ahead", F.sum("size").over(within) - F.col("size"))


def layout(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs: as for ``bucketed``. Adds also ``start``: the words of the source before the document."""
    docs = bucketed(docs, bucket_rows)
    buckets = docs.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = buckets.select("source_no", "bucket", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("base"))
    docs = docs.join(store.keep(base, "buckets"), ["source_no", "bucket"])
    return docs.withColumn("start", F.col("base") + F.col("ahead"))


def _draw(quotas: list[int], shard_slots: int, seed: int):
    quota = np.array(quotas, dtype=np.int64)
    total = int(quota.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                n = min(shard_slots, total - shard * shard_slots)
                drawn = np.random.default_rng([seed, shard]).multinomial(n, quota / total)
                at = np.flatnonzero(drawn)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard)), pa.array(at + 1), pa.array(drawn[at]), pa.array((np.cumsum(drawn) - drawn)[at])],
                    names=["shard", "source_no", "drawn", "slot_base"],
                )

    return run


def _assign(quotas: list[int], blocks: list[int], drawn: list[int], shard_slots: int, seed: int):
    quota, n_blocks, got = (np.array(x, dtype=np.int64) for x in (quotas, blocks, drawn))
    total = int(quota.sum())
    over_base = np.cumsum(np.maximum(got - quota, 0)) - np.maximum(got - quota, 0)
    short = np.maximum(quota - got, 0)
    short_end = np.cumsum(short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, count, slot_base, first in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                turn = first + np.arange(count)
                source = np.full(count, number - 1)
                over = turn >= quota[number - 1]
                spare = over_base[number - 1] + turn[over] - quota[number - 1]
                taker = np.searchsorted(short_end, spare, side="right")
                source[over] = taker
                turn[over] = got[taker] + spare - (short_end - short)[taker]
                block = np.empty(count, dtype=np.int64)
                for s in np.unique(source):
                    for pass_no in np.unique(turn[source == s] // n_blocks[s]):
                        here = (source == s) & (turn // n_blocks[s] == pass_no)
                        block[here] = permuted(turn[here] % n_blocks[s], int(n_blocks[s]), seed, int(s), int(pass_no))
                in_shard = min(shard_slots, total - shard * shard_slots)
                slot = permuted(slot_base + np.arange(count), in_shard, seed, shard)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, shard)), pa.array(slot), pa.array(source + 1), pa.array(block)],
                    names=["shard", "slot", "source_no", "block"],
                )

    return run


def slots(spark, sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix itself: which block of which source stands at each slot of each output shard.
    One number per source comes to the driver."""
    rows = sources.select("source_no", "quota", "n_blocks").orderBy("source_no").collect()
    quotas, blocks = [r.quota for r in rows], [r.n_blocks for r in rows]
    shards = spark.range(-(-sum(quotas) // shard_slots))
    drawn = shards.mapInArrow(_draw(quotas, shard_slots, seed), "shard long, source_no long, drawn long, slot_base long")
    drawn = store.keep(drawn, "draws")
    got = {r.source_no: r.n for r in drawn.groupBy("source_no").agg(F.sum("drawn").alias("n")).collect()}
    along = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    turns = drawn.withColumn("first", F.coalesce(F.sum("drawn").over(along), F.lit(0)))
    totals = [got.get(r.source_no, 0) for r in rows]
    return turns.mapInArrow(
        _assign(quotas, blocks, totals, shard_slots, seed), "shard long, slot long, source_no long, block long"
    )


def spans(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The stretch of each document in each block: adds block and overlap (words). Documents without
    words have one row with overlap 0."""
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    numbers = F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))
    out = docs.withColumn("block", F.explode(numbers))
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    overlap = F.when(F.col("size") > 0, end - F.greatest("start", F.col("block") * block_words)).otherwise(F.lit(0))
    return out.withColumn("overlap", overlap.cast("long"))


def _bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text in UTF-8 start and end."""
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
    return edges[::2], edges[1::2]


def _zstd() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def packed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source and a hash of the text; size as ``sized`` counts it; bytes and text: the length of the text and the text, compressed."""

    def pack(text: pa.Array) -> pa.Array:
        codec, rows = _zstd(), (t.as_py() or b"" for t in text)
        made = [(len(_bounds(t)[0]), len(t), codec.compress(t, asbytes=True)) for t in rows]
        kind = pa.struct([("size", pa.int64()), ("bytes", pa.int64()), ("text", pa.binary())])
        return pa.array(made, kind)

    made = F.arrow_udf(pack, "size long, bytes long, text binary")(F.col(text_col).cast("binary"))
    text_hash = F.xxhash64(text_col).alias("text_hash")
    docs = documents.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), text_hash, made.alias("made"))
    return docs.select("id", "source", "text_hash", "made.*")


def _by_number(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with their source's number, and the documents it has. There is one row per source."""
    of = sources.select(F.col("source").alias("of"), "source_no", "n_docs")
    return docs.join(F.broadcast(of), F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")


def _numbered(documents: DataFrame, id_col, text_col, source_col, weights, repeats, block_words, with_text: bool):
    """Stored sources, and the documents with their source's number; texts, as ``packed`` has them, only where they are asked for."""
    docs = sized(documents, text_col, source_col)
    docs = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"row.{id_col}").alias("id"), "size", "source", "text_hash")
    docs = store.keep(docs, "sized")
    sources = store.keep(targets(docs, weights, repeats, block_words), "sources")
    return sources, _by_number(packed(documents, id_col, text_col, source_col) if with_text else docs, sources)


def _cut(block_words: int, schema: pa.Schema):
    def chunks(shard, *columns):
        order, codec = np.argsort(shard, kind="stable"), _zstd()
        pieces = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names).take(pa.array(order))
        firsts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        raw = [pieces.slice(a, z - a).serialize() for a, z in zip(firsts, [*firsts[1:], len(order)], strict=True)]
        found = pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(shard[order][firsts]), pa.array([r.size for r in raw]), found], names=["shard", "bytes", "chunk"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _zstd()
        for batch in batches:
            goes = batch.column("goes")
            ends = goes.offsets.to_numpy() - goes.offsets[0].as_py()
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            block, shard, slot = (goes.flatten().field(k).to_numpy() for k in ("block", "shard", "slot"))
            source_no, start, size = (batch.column(k).to_numpy()[row] for k in ("source_no", "start", "size"))
            at = block * block_words - start
            low, high = np.maximum(at, 0), np.minimum(at + block_words, size)

            def cut(words, first):
                k = slice(first, first + len(words))
                ids = batch.column("id").take(pa.array(row[k]))
                return chunks(shard[k], slot[k], source_no[k], block[k], (low - at)[k], start[k], ids, (high - low)[k], pa.array(words, pa.binary()))

            words, held, done = [], 0, 0
            for i, (text, length) in enumerate(zip(batch.column("text"), batch.column("bytes").to_pylist(), strict=True)):
                data = codec.decompress(text.as_buffer(), length, asbytes=True)
                first, last = _bounds(data)
                k = slice(ends[i], ends[i + 1])
                for a, z in zip(first[low[k]].tolist(), last[high[k] - 1].tolist(), strict=True):
                    words.append(b" ".join(data[a:z].split()))
                    held += z - a
                    if held >= HELD_BYTES:
                        yield cut(words, done)
                        words, held, done = [], 0, done + len(words)
            if words:
                yield cut(words, done)

    return run


def _unpack(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _zstd()
        for batch in batches:
            for shard, length, chunk in zip(*(batch.column(i) for i in range(3)), strict=True):
                pieces = pa.ipc.read_record_batch(codec.decompress(chunk.as_buffer(), length.as_py()), schema)
                yield pa.RecordBatch.from_arrays([pa.repeat(shard, len(pieces)), *pieces.columns], names=["shard", *schema.names])

    return run


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring pieces of one slot become one row."""

    def whole(pieces, firsts):
        def lists(values):
            return pa.ListArray.from_arrays(pa.array([*firsts, len(pieces)], pa.int32()), values)

        heads = [pieces.column(k).take(pa.array(firsts)) for k in ("shard", "slot", "source_no", "block")]
        words = pc.binary_join(lists(pieces.column("words")), b" ")
        parts = lists(pa.StructArray.from_arrays([pieces.column(k) for k in ("start", "id", "n")], ["start", "id", "n"]))
        return pa.RecordBatch.from_arrays([*heads, words, parts], names=["shard", "slot", "source_no", "block", "words", "parts"])

    rest = None
    for batch in batches:
        pieces = batch if rest is None else pa.concat_batches([rest, batch])
        shard, slot = (pieces.column(k).to_numpy() for k in ("shard", "slot"))
        firsts = np.flatnonzero((np.diff(shard, prepend=-1) != 0) | (np.diff(slot, prepend=-1) != 0))
        if len(firsts) > 1:
            yield whole(pieces.slice(0, firsts[-1]), firsts[:-1])
        rest = pieces.slice(firsts[-1]) if len(firsts) else None
    if rest is not None:
        yield whole(rest, np.zeros(1, np.int64))


def placed(texts: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """texts: id, source_no, start, size, and bytes and text as ``packed`` has them; goes: block, shard and slot of each place in the mix that has
    words of the document. One row per slot: shard, slot, source_no, block, words (joined by blanks) and parts, the
    documents (start, id, n words) that it was cut from in order. A block has at most ``block_words`` parts.
    The stretches that a task cuts for one shard travel as one compressed chunk."""
    kind = texts.schema["id"].dataType.simpleString()
    pieces = f"slot long, source_no long, block long, place long, start long, id {kind}, n long, words binary"
    schema = to_arrow_schema(StructType.fromDDL(pieces))
    texts = texts.select(F.col("source_no").cast("long"), "start", "id", "size", "bytes", "text", "goes")
    chunks = texts.mapInArrow(_cut(block_words, schema), "shard long, bytes long, chunk binary").repartition("shard")
    rows = chunks.mapInArrow(_unpack(schema), f"shard long, {pieces}").sortWithinPartitions("shard", "slot", "place")
    whole = f"shard long, slot long, source_no long, block long, words binary, parts array<struct<start:bigint,id:{kind},n:bigint>>"
    return rows.mapInArrow(_join, whole).withColumn("words", F.col("words").cast("string"))


def blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs: as ``layout`` returns them, with text. The blocks in the order of their sources, each once: source_no, block, words, parts."""
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    own = F.transform(F.sequence(first, last), lambda b: F.struct(b.alias("block"), F.col("source_no").cast("long").alias("shard"), b.alias("slot")))
    return placed(docs.filter("size > 0").withColumn("goes", own), block_words).select("source_no", "block", "words", "parts")


def write_mix(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
              repeats: int = REPEATS, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The mix as text, stored: shard, slot, source_no, source, block, words, parts (start, id, n; ``start`` is the document's place in its source),
    each shard whole in one file and in the order of its slots; and the report of ``mix``, counted over what was stored. The
    documents are read twice: for their sizes, and for the texts once it is known where these go."""
    spark = documents.sparkSession
    sources, numbered = _numbered(documents, id_col, text_col, source_col, weights, repeats, block_words, with_text=False)
    laid = store.keep(layout(numbered).select("id", "size", "source_no", "bucket", "ahead", "start"), "laid")
    # The few rows that both sides unfold from say nothing about their sizes.
    places = slots(spark, sources, shard_slots, seed)
    goes = spans(laid.filter("size > 0"), block_words).hint("merge").join(places, ["source_no", "block"])
    # Dealt like the texts, which then stay where they are in the join.
    goes = goes.repartition("source_no", "bucket").groupBy("source_no", "bucket", "ahead", "start")
    goes = goes.agg(F.collect_list(F.struct("block", "shard", "slot")).alias("goes"))
    texts = _by_number(packed(documents.filter(F.col(text_col).rlike(WORD)), id_col, text_col, source_col), sources)
    texts = bucketed(texts).drop("place", "text_hash").hint("merge").join(goes, ["source_no", "bucket", "ahead"])
    mixed = placed(texts, block_words).join(F.broadcast(sources.select("source_no", "source")), "source_no")
    mixed = mixed.select("shard", "slot", "source_no", "source", "block", "words", "parts")
    with store.settings(spark, WRITE_SETTINGS):
        mixed = store.keep(mixed, "shards", compression="zstd")
    found = store.keep(taken_of(mixed), "taken").select(F.col("source_no").alias("of"), F.col("start").alias("at"), "taken")
    same = (F.col("source_no") == F.col("of")) & (F.when(F.col("size") > 0, F.col("start")) == F.col("at"))
    report = laid.join(found, same, "left").join(sources.select("source_no", "source", "source_size", "target"), "source_no")
    taken = F.coalesce("taken", F.lit(0)).alias("taken")
    return mixed, report.select("id", "source", "size", "source_size", "target", taken)


def taken_of(mixed: DataFrame) -> DataFrame:
    """(source_no, start, taken): the words that stored shards hold of each document that they have words of."""
    return mixed.select("source_no", F.inline("parts")).groupBy("source_no", "start").agg(F.sum("n").alias("taken"))


def mix(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        repeats: int = REPEATS, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(id, source, size, source_size, target, taken) for each document."""
    spark = documents.sparkSession
    sources, numbered = _numbered(documents, id_col, text_col, source_col, weights, repeats, block_words, with_text=False)
    # Stored, so that its size is known: the few rows that the slots unfold from say nothing about it.
    times = slots(spark, sources, shard_slots, seed).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    times = store.keep(times, "times")
    parts = spans(layout(numbered), block_words).select("rid", "id", "size", "source_no", "block", "overlap")
    part = F.col("overlap") * F.coalesce("times", F.lit(0))
    taken = parts.join(times, ["source_no", "block"], "left").groupBy("rid", "id", "size", "source_no").agg(F.sum(part).alias("taken"))
    return taken.join(sources.select("source_no", "source", "source_size", "target"), "source_no").select(
        "id", "source", "size", "source_size", "target", "taken"
    )


def op6(spark, sf_dir: str) -> DataFrame:
    documents = store.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return write_mix(documents)[1].select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
