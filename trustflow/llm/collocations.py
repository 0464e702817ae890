"""Phrase collocations: frequency-ranked symbols, pair tiles counted directly, frequent pairs ranked again as symbols.

1. Blocks. A task cuts its texts into pieces and words and keeps them per language in blocks of ``BLOCK_BYTES``: the
   distinct words with their counts, and the text as positions in that list. Pieces are never cut; a longer piece is a block of its own.
2. Symbols of level 1 are the words with ``MIN_COUNT`` occurrences, numbered over all tasks from the most frequent on. The first
   ``HEAD`` of them, of ``HEAD_BYTES`` at most each, are a table of bounded size that every task holds; a block gets the numbers
   of its other words by a join on the word, so no task holds the whole vocabulary and no frequent word is a hot key. The
   same holds for the pairs of each level.
3. Tiles. In a block symbols stand in the order of their numbers, so frequent ones have small positions. Neighbouring symbols
   (x, y) fall into tiles of ``TILE`` x ``TILE`` positions. Of the ``DENSE_TILES`` x ``DENSE_TILES`` first tiles those that hold a pair
   per ``FILL`` cells or more are counted by one ``bincount`` over the cells; all other pairs are sorted
   coordinates counted as runs. Spark sums the counts of all blocks per pair of symbols, combined before the shuffle.
4. Recursion. Pairs with MIN_COUNT occurrences are numbered from the most frequent on: the symbols of the next level. Two
   neighbouring symbols of level k overlap in k - 1 words, so a pair of them is a phrase of k + 1 words. Symbols without a neighbour
   are left out of the stored blocks. Before a block's words or pairs are joined with the frequent ones, a bitmap of fixed size
   (``FILTER_BITS``) leaves out most that are not frequent; where it is full it leaves out fewer and the join decides alike.
5. A phrase carries the counts of its first and last words of each length, so all cuts are scored in one row, in whole
   numbers of 38 digits. A phrase inside a longer candidate as frequent as itself is also inside one that is
   one word longer and as frequent, so it is compared with those alone.

Defined results: null and empty texts have no words; rows without a language are ``und``; repeated rows count each time; equal
scores are ordered by count, then by the phrase's bytes; the empty table gives the empty table. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from trustflow.llm import store

MIN_COUNT = 100
LONGEST = 5  # words of a phrase
BEST = 2000  # phrases reported per language
BLOCK_BYTES = 4 << 20
TILE, DENSE_TILES, FILL = 1024, 64, 16
FILTER_BITS = 1 << 23
HEAD, HEAD_BYTES = 1 << 18, 64
UNKNOWN = "und"


@dataclass(frozen=True)
class Sizes:
    """What bounds memory and time; results do not depend on it."""

    block_bytes: int = BLOCK_BYTES
    tile: int = TILE
    dense_tiles: int = DENSE_TILES
    fill: int = FILL
    filter_bits: int = FILTER_BITS
    head: int = HEAD


_BREAK = b"."
_BREAKS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 9)


def _packed(codes: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(codes.astype("<i4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<i4").astype(np.int64)


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about a size, cut at breaks alone."""
    while len(text) > size:
        at = text.rfind(_BREAK, 0, size)
        at = text.find(_BREAK, size) if at < 0 else at
        if at < 0:
            break
        yield text[:at]
        text = text[at + 1 :]
    yield text


def tokens(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and the text as positions among them, -1 at a break."""
    spaced = pa.array([text.replace(_BREAK, b" . ")], pa.binary()).view(pa.string())
    coded = pc.ascii_split_whitespace(spaced).flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    kept = codes[~np.isin(codes, np.flatnonzero(pc.equal(words, "").to_numpy(zero_copy_only=False)))]
    real = pc.and_(pc.not_equal(words, "."), pc.not_equal(words, "")).to_numpy(zero_copy_only=False)
    place = np.where(real, np.cumsum(real) - 1, -1)
    return words.filter(pa.array(real)), place[kept]


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    block = TaskContext.get().partitionId() << 40

    def made(lang):
        nonlocal block
        size.pop(lang)
        words, codes = tokens(_BREAK.join(held.pop(lang)))
        block += 1
        counts = np.bincount(codes[codes >= 0], minlength=len(words))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), x) for x in (words, pa.array(counts, pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([lang]), *lists, pa.array([_packed(codes)])], names=["block", "lang", "words", "counts", "codes"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            for part in _slices((text.as_py() or b"").translate(_BREAKS), block_bytes):
                held.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part) + 1
                if size[lang] >= block_bytes:
                    yield made(lang)
                elif sum(size.values()) >= 2 * block_bytes:
                    yield made(max(size, key=size.get))
    while held:
        yield made(next(iter(held)))


def blocks(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stored (block, lang, words, counts, codes)."""
    rows = documents.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    return store.keep(rows.mapInArrow(lambda batches: _blocks(batches, block_bytes), "block long, lang string, words array<string>, counts array<long>, codes binary"), "blocks")


def _ranked(symbols: DataFrame) -> DataFrame:
    """Stored rows numbered (id) from the most frequent on. Numbers are ordered, not dense."""
    return store.keep(symbols.orderBy(F.desc("n"), *[c for c in symbols.columns if c != "n"]).withColumn("id", F.monotonically_increasing_id()), "symbols")


def vocabulary(made: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Stored (lang, word, n, id) of the frequent words."""
    each = made.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("c")))).toDF("lang", "word", "c")
    return _ranked(each.groupBy("lang", "word").agg(F.sum("c").alias("n")).filter(F.col("n") >= min_count))


class PairHead:
    """The most frequent pairs (x, y) with their ids, 24 bytes each."""

    def __init__(self, frequent: DataFrame, size: int):
        top = frequent.orderBy("id").limit(size).select("x", "y", "id").toArrow()
        x, y, ids = (top.column(c).to_numpy() for c in ("x", "y", "id"))
        self.xs, self.ys = np.unique(x), np.unique(y)
        keys = np.searchsorted(self.xs, x) * max(1, len(self.ys)) + np.searchsorted(self.ys, y)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]

    def ids_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1 for a pair that is not here."""
        if not len(self.keys):
            return np.full(len(x), -1, dtype=np.int64)
        i, j = (np.minimum(np.searchsorted(known, z), len(known) - 1) for known, z in ((self.xs, x), (self.ys, y)))
        key = i * len(self.ys) + j
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.xs[i] == x) & (self.ys[j] == y) & (self.keys[at] == key), self.ids[at], -1)


def _sequence(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Global symbols in a row (-1: none) as distinct symbols in ascending order and positions among them. What has no neighbour goes."""
    some = values >= 0
    beside = np.zeros(len(some) + 2, dtype=bool)
    beside[1:-1] = some
    paired = some & (beside[:-2] | beside[2:])
    # Of several places without a symbol one stays.
    keep = paired | np.concatenate([[True], paired[:-1]])
    kept = np.where(paired, values, -1)[keep]
    symbols, codes = np.unique(kept[kept >= 0], return_inverse=True)
    out = np.full(len(kept), -1, dtype=np.int64)
    out[kept >= 0] = codes
    return symbols, out


def _encode(head: PairHead | dict):
    """The block's symbols of this level and the text as positions among them. The codes list words (level 1, ``head`` as from
    ``head_table``) or symbols, whose distinct pairs are looked up; ``found`` has the symbols that the head lacks, by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                codes = _unpacked(batch.column("codes")[i].as_py())
                if isinstance(head, dict):
                    listed, words = codes, batch.column("words")[i].values
                    there, ids = _in_head(words, batch.column("lang")[i].as_py(), head)
                    table = np.full(len(words) + 1, -1, dtype=np.int64)  # the last one is for -1
                    table[np.flatnonzero(there)] = ids
                else:
                    spots, keys = _pairs(codes)
                    distinct, where = np.unique(keys, return_inverse=True)
                    listed = np.full(max(len(codes) - 1, 0), -1, dtype=np.int64)
                    listed[spots] = where
                    symbols = batch.column("symbols")[i].values.to_numpy()
                    table = np.append(head.ids_of(symbols[distinct >> 32], symbols[distinct & 0xFFFFFFFF]), -1)
                rows = batch.column("found")[i].values
                if rows is not None:
                    table[rows.field("place").to_numpy()] = rows.field("id").to_numpy()
                symbols, out = _sequence(table[listed])
                if len(symbols):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("block").slice(i, 1), pa.array([symbols], pa.list_(pa.int64())), pa.array([_packed(out)])],
                        names=["block", "symbols", "codes"],
                    )

    return run


_LEVEL = "block long, symbols array<long>, codes binary"


def _pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where neighbouring symbols begin, and both positions as one number; positions are 32-bit."""
    spots = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    return spots, codes[spots] << 32 | codes[spots + 1]


def count_pairs(codes: np.ndarray, sizes: Sizes = Sizes()) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of positions, ascending, and their counts, by tiles."""
    tile_size, tiles, whole = sizes.tile, sizes.dense_tiles, sizes.tile**2
    _, keys = _pairs(codes)
    a, b = keys >> 32, keys & 0xFFFFFFFF
    row, column = a // tile_size, b // tile_size
    near = (row < tiles) & (column < tiles)
    tile = np.where(near, row * tiles + column, tiles * tiles)
    held = np.bincount(tile, minlength=tiles * tiles + 1)
    held[-1] = 0
    dense = np.flatnonzero(held * sizes.fill >= whole)
    found, counts = [], []
    is_dense = np.isin(tile, dense)
    of, cells = tile[is_dense], (a[is_dense] % tile_size) * tile_size + b[is_dense] % tile_size
    for t in dense.tolist():
        table = np.bincount(cells[of == t], minlength=whole)
        cell = np.flatnonzero(table)
        found.append((t // tiles * tile_size + cell // tile_size) << 32 | (t % tiles * tile_size + cell % tile_size))
        counts.append(table[cell])
    sparse, n = np.unique(keys[~is_dense], return_counts=True)
    found, counts = np.concatenate([*found, sparse]), np.concatenate([*counts, n])
    order = np.argsort(found)
    return found[order], counts[order]


def _count(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            symbols = batch.column("symbols")[i].values.to_numpy()
            keys, counts = count_pairs(_unpacked(batch.column("codes")[i].as_py()), sizes)
            for k in range(0, len(keys), 1 << 20):
                part = keys[k : k + (1 << 20)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(symbols[part >> 32]), pa.array(symbols[part & 0xFFFFFFFF]), pa.array(counts[k : k + (1 << 20)], pa.int64())], names=["x", "y", "c"]
                )


def _bit(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (y.astype(np.uint64) + np.uint64(0x7F4A7C15))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(bits)).astype(np.int64)


def pair_filter(frequent: DataFrame, bits: int) -> np.ndarray:
    """One bit per hashed pair (x, y), of fixed size whatever the number of pairs."""

    def mark(batches):
        for batch in batches:
            at = _bit(batch.column("x").to_numpy(), batch.column("y").to_numpy(), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], names=["i", "word"])

    words = frequent.select("x", "y").mapInArrow(mark, "i long, word long").groupBy("i").agg(F.bit_or("word").alias("word")).toArrow()
    table = np.zeros((bits >> 5) + 1, dtype=np.uint32)  # bits / 32 numbers at most
    table[words.column("i").to_numpy()] = words.column("word").to_numpy()
    return table


def head_table(words: DataFrame, size: int) -> dict[str, tuple[pa.Array, np.ndarray]]:
    """The most frequent words of each language with their ids, ``size`` x ``HEAD_BYTES`` bytes of words at most."""
    top = words.orderBy("id").limit(size).filter(F.octet_length("word") <= HEAD_BYTES).select("lang", "word", "id").toArrow().combine_chunks()
    found = {}
    for lang in pc.unique(top.column("lang")).to_pylist():
        own = top.filter(pc.equal(top.column("lang"), lang))
        found[lang] = own.column("word").combine_chunks(), own.column("id").to_numpy()
    return found


def _in_head(words: pa.Array, lang: str, heads: dict) -> tuple[np.ndarray, np.ndarray]:
    """For each word whether it is in the head table, and the ids of those that are."""
    if lang not in heads:
        return np.zeros(len(words), dtype=bool), np.empty(0, dtype=np.int64)
    listed, ids = heads[lang]
    at = pc.fill_null(pc.index_in(words, value_set=listed.cast(words.type)), -1).to_numpy()
    return at >= 0, ids[at[at >= 0]]


def _tails(heads: dict, table: np.ndarray, bits: int):
    """The block's words that are not in the head table and that the bitmap lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                lang, words = batch.column("lang")[i].as_py(), batch.column("words")[i].values
                rest = np.flatnonzero(~_in_head(words, lang, heads)[0])
                hashes = (xxhash.xxh64_intdigest(w.as_buffer(), 42) for w in words.take(pa.array(rest)).cast(pa.binary()))
                y = np.fromiter(hashes, dtype=np.uint64, count=len(rest)).view(np.int64)
                x = np.full(len(rest), xxhash.xxh64_intdigest(lang.encode(), 42), dtype=np.uint64).view(np.int64)
                at = _bit(x, y, bits)
                places = rest[table[at >> 5] >> (at & 31).astype(np.uint32) & 1 == 1]
                block = np.full(len(places), batch.column("block")[i].as_py(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), pa.array(places, pa.int64()), pa.array([lang] * len(places), pa.string()), words.take(pa.array(places)).cast(pa.string())],
                    names=["block", "place", "lang", "word"],
                )

    return run


def first_level(made: DataFrame, words: DataFrame, sizes: Sizes) -> DataFrame:
    """Blocks in symbols of level 1."""
    heads = head_table(words, sizes.head)
    # Spark's xxhash64 of one text is XXH64 with seed 42.
    known = pair_filter(words.select(F.xxhash64("lang").alias("x"), F.xxhash64("word").alias("y")), sizes.filter_bits)
    tails = made.select("block", "lang", "words").mapInArrow(_tails(heads, known, sizes.filter_bits), "block long, place long, lang string, word string")
    placed = tails.join(words.select("lang", "word", "id").hint("merge"), ["lang", "word"]).select("block", "place", "id")
    joined = made.select("block", "lang", "words", "codes").join(_lists(placed), "block", "left")
    return store.keep(joined.mapInArrow(_encode(heads), _LEVEL), "level")


def _lists(placed: DataFrame) -> DataFrame:
    """(block, found): symbols by their place, bounded by the block. Stored, so the join knows how large it is."""
    return store.keep(placed.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("found")), "lists")


def _sift(head: PairHead, table: np.ndarray, bits: int):
    """The block's distinct pairs that are not in the head and that the bitmap lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                symbols = batch.column("symbols")[i].values.to_numpy()
                keys = np.unique(_pairs(_unpacked(batch.column("codes")[i].as_py()))[1])
                x, y = symbols[keys >> 32], symbols[keys & 0xFFFFFFFF]
                at = _bit(x, y, bits)
                there = np.flatnonzero((table[at >> 5] >> (at & 31).astype(np.uint32) & 1 == 1) & (head.ids_of(x, y) < 0))
                block = np.full(len(there), batch.column("block")[i].as_py(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(there), pa.array(x[there]), pa.array(y[there])], names=["block", "place", "x", "y"])

    return run


def next_level(level: DataFrame, frequent: DataFrame, sizes: Sizes) -> DataFrame:
    """Blocks in symbols of the next level: the frequent pairs of this one."""
    head = PairHead(frequent, sizes.head)
    known = pair_filter(frequent, sizes.filter_bits)
    sifted = level.mapInArrow(_sift(head, known, sizes.filter_bits), "block long, place long, x long, y long")
    placed = sifted.join(frequent.select("x", "y", "id").hint("merge"), ["x", "y"]).select("block", "place", "id")
    return store.keep(level.join(_lists(placed), "block", "left").mapInArrow(_encode(head), _LEVEL), "level")


def phrases(made: DataFrame, min_count: int = MIN_COUNT, sizes: Sizes = Sizes()) -> Iterator[DataFrame]:
    """Frequent phrases level by level from two words on, stored: (id, x, y, n, lang, words, pre, suf); x and y are the ids of
    all words but the last and but the first, pre and suf the counts of its first and last words of each length."""
    words = vocabulary(made, min_count)
    level = first_level(made, words, sizes)
    known = words.select("id", "n", "lang", F.array("word").alias("words"), F.array("n").alias("pre"), F.array("n").alias("suf"))
    for size in range(2, LONGEST + 1):
        counts = level.mapInArrow(lambda batches: _count(batches, sizes), "x long, y long, c long").groupBy("x", "y").agg(F.sum("c").alias("n"))
        frequent = _ranked(counts.filter(F.col("n") >= min_count))
        head = known.select(F.col("id").alias("x"), "lang", F.col("words").alias("head"), "pre")
        tail = known.select(F.col("id").alias("y"), F.element_at("words", -1).alias("end"), "suf")
        joined = frequent.join(head.hint("merge"), "x").join(tail.hint("merge"), "y")
        known = store.keep(
            joined.select(
                "id", "x", "y", "n", "lang",
                F.concat("head", F.array("end")).alias("words"),
                F.concat("pre", F.array("n")).alias("pre"), F.concat("suf", F.array("n")).alias("suf"),
            ),
            "phrases",
        )
        yield known
        if size < LONGEST:
            level = next_level(level, frequent, sizes)


def collocations(
    documents: DataFrame, text_col: str = "text", lang_col: str = "lang", best: int = BEST, min_count: int = MIN_COUNT, sizes: Sizes = Sizes()
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language that no longer one replaces."""
    made = blocks(documents, text_col, lang_col, sizes.block_bytes)
    levels = list(phrases(made, min_count, sizes))
    kept = levels[-1]
    for shorter, longer in zip(levels[:-1], levels[1:], strict=True):
        around = longer.select(F.col("x").alias("id"), "n").union(longer.select(F.col("y").alias("id"), "n"))
        around = around.groupBy("id").agg(F.max("n").alias("most"))
        alone = shorter.join(around.hint("merge"), "id", "left").filter("most IS NULL OR most < n").drop("most")
        kept = kept.unionByName(alone)
    total = made.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c).alias("c")).groupBy("lang").agg(F.sum("c").alias("total"))
    cuts = F.transform(
        F.expr("sequence(1, size(words) - 1)"),
        lambda k: F.struct(
            F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("n").cast("decimal(17,0)") * F.col("total").cast("decimal(17,0)"), F.element_at("pre", k).cast("decimal(19,0)") * F.element_at("suf", F.size("words") - k).cast("decimal(19,0)")).alias("score"),
            k.alias("k"), F.element_at("pre", k).alias("l"), F.element_at("suf", F.size("words") - k).alias("r"),
        ),
    )
    scored = kept.join(total, "lang").withColumn("cut", F.array_min(cuts))
    rows = scored.select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12(spark, sf_dir: str) -> DataFrame:
    return collocations(store.table(spark, sf_dir, "documents"))
