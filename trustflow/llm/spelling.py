"""Spelling variants: words one inserted, deleted or replaced code point apart, by a dictionary of trie-node pairs.

1. Words and their counts are summed up in each task before they are shuffled, so a word that fills a third of the corpus is a row
   per task. A word's id follows its rank: more occurrences first, then code points.
2. Tries. The words stand in one sorted order over all tasks, which is the trie's order: a word shares with the one before it
   the nodes of their common prefix and opens new ones for the rest. A task numbers the nodes it opens; where
   its first word shares nodes with the tasks before it, these numbers are aliases (one row per task
   tells the driver which). The reversed words give the trie of suffixes in the same way.
3. Dictionary. A word of length L enters under the pair (node of the prefix before i, node of the suffix after i) for each position i
   that it may skip, and under (node before i, node from i on) for each place i at which it may be cut. A pair of nodes
   stands for one prefix and one suffix exactly, so two words that skip under one pair differ in the skipped point
   alone, and a word cut there lacks just the point that the others skip. Equal points in a row name the same shorter word;
   only the first of them counts. A pair has at most one cut word and one skipping word per letter of the alphabet, so
   groups are bounded; each member gets the number of its near words and the best of them, no pairs are made.
4. A word's form is its best near word if that has at least ``FORM_RATIO`` times its occurrences. Counts grow by this ratio along forms,
   so chains are short; roots are found by doubling.

Defined results: null and empty texts have no words; a repeated row counts each time; ties go to the word least in code points; a word
without near words has n_near 0 and no form; the empty table gives the empty table. Words of any length are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from trustflow.llm import store

MIN_LENGTH, MIN_COUNT, FORM_RATIO = 6, 5, 5
_RUNS = re.compile("[a-zÀ-ÿ]+")
_HELD = 300_000  # distinct words that a task holds before it passes their counts on
_PART_BITS = 40
_ROOT = -1
_CUT, _SKIP, _FIRST_SKIP = 0, 1, 2  # kinds of entries; a first skip is one that names a shorter word
SLIP_EVERY = 199


def runs(text: bytes | None) -> list[str]:
    """Maximal runs of letters; bytes.lower() knows A-Z only."""
    return _RUNS.findall(text.lower().decode("utf-8", "replace")) if text else []


def slipped(doc_id, counts: Counter) -> Iterator[tuple[str, int]]:
    """The contract's rule: in a run whose hash with the document's id SLIP_EVERY divides, one code point is lost."""
    start = zlib.crc32(b"%s:" % ("" if doc_id is None else str(doc_id)).encode())
    for run, n in counts.items():
        h = zlib.crc32(run.encode(), start)
        if h % SLIP_EVERY == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1 :]
        yield run, n


def plain(doc_id, counts: Counter):
    return counts.items()


def _tally(rule: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                for word, n in rule(doc_id, Counter(runs(text.as_py()))):
                    if len(word) >= MIN_LENGTH:
                        held[word] = held.get(word, 0) + n
                if len(held) > _HELD:
                    yield _counts(held)
                    held = {}
        yield _counts(held)

    return run


def _counts(held: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])


def word_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Callable = plain) -> DataFrame:
    """(word, n): words of MIN_LENGTH code points and MIN_COUNT occurrences. rule: what becomes of a document's runs."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(_tally(rule), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= MIN_COUNT)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    opened, seq, before, path = part << _PART_BITS, 0, "", []
    for batch in batches:
        nodes = []
        for word in batch.column("word").to_pylist():
            same = _common(before, word)
            path = path[:same] + list(range(opened, opened + len(word) - same))
            opened += len(word) - same
            before = word
            nodes.append(path)
        n = len(nodes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()), batch.column("wid"), batch.column("word"), pa.array(nodes, pa.list_(pa.int64()))],
            names=["part", "seq", "wid", "word", "nodes"],
        )
        seq += n


def _common(a: str, b: str) -> int:
    i, most = 0, min(len(a), len(b))
    while i < most and a[i] == b[i]:
        i += 1
    return i


def trie(words: DataFrame) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """words: (wid, word). Returns stored (wid, word, nodes), a node for each prefix from the shortest on, and the aliases:
    numbers, ascending, and the numbers that they stand for."""
    rows = words.repartitionByRange("word").sortWithinPartitions("word").select("wid", "word")
    stored = store.keep(rows.mapInArrow(_number, "part int, seq long, wid long, word string, nodes array<long>"), "trie")
    ends = stored.groupBy("part").agg(F.min_by("word", "seq").alias("first"), F.max_by(F.struct("word", "nodes"), "seq").alias("last"))
    alias: dict[int, int] = {}
    before, path = "", []
    for end in sorted(ends.collect()):  # one row per task
        for i in range(_common(before, end.first)):
            alias[(end.part << _PART_BITS) + i] = path[i]
        before, path = end.last.word, [alias.get(x, x) for x in end.last.nodes]
    numbers = np.array(sorted(alias), dtype=np.int64)
    return stored.select("wid", "word", "nodes"), (numbers, np.array([alias[x] for x in numbers.tolist()], dtype=np.int64))


def _resolved(nodes: np.ndarray, aliases: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    numbers, real = aliases
    if not len(numbers):
        return nodes
    at = np.minimum(np.searchsorted(numbers, nodes), len(numbers) - 1)
    return np.where(numbers[at] == nodes, real[at], nodes)


def _enter(forward_aliases, backward_aliases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points = np.frombuffer("".join(batch.column("word").to_pylist()).encode("utf-32-le"), dtype="<u4")
            ahead = _resolved(batch.column("ahead").flatten().to_numpy(), forward_aliases)
            back = _resolved(batch.column("back").flatten().to_numpy(), backward_aliases)
            long = np.diff(batch.column("ahead").offsets.to_numpy()).astype(np.int64)
            start = np.concatenate([[0], np.cumsum(long)[:-1]])
            row = np.repeat(np.arange(len(long)), long + 1)
            i = np.arange(len(row)) - np.repeat(start + np.arange(len(long)), long + 1)  # 0 to the word's length
            prefix = np.where(i == 0, _ROOT, ahead[np.maximum(start[row] + i - 1, 0)])
            suffix = np.where(i == long[row], _ROOT, back[np.minimum(start[row] + long[row] - i - 1, len(back) - 1)])
            wid = batch.column("wid").to_numpy()[row]
            skip = np.flatnonzero(i < long[row])  # the entry after it has the suffix that it needs
            own = points[start[row[skip]] + i[skip]]
            first = (i[skip] == 0) | (own != points[start[row[skip]] + i[skip] - 1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([prefix, prefix[skip]])),
                    pa.array(np.concatenate([suffix, suffix[skip + 1]])),
                    pa.array(np.concatenate([wid << 2 | _CUT, wid[skip] << 2 | np.where(first, _FIRST_SKIP, _SKIP)])),
                ],
                names=["p", "s", "entry"],
            )

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of (p, s, entry). A pair that goes on in the next batch waits for it."""
    rest = np.empty((3, 0), dtype=np.int64)
    for batch in batches:
        now = np.concatenate([rest, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        if not now.shape[1]:
            continue
        other = np.flatnonzero((now[0] != now[0, -1]) | (now[1] != now[1, -1]))
        ends = other[-1] + 1 if len(other) else 0
        rest = now[:, ends:]
        if ends:
            yield _near_in(now[:, :ends])
    if rest.shape[1]:
        yield _near_in(rest)


def _near_in(rows: np.ndarray) -> pa.RecordBatch:
    """For each member of each pair how many of the others are near it and the least id of these."""
    none = np.iinfo(np.int64).max
    p, s, entry = rows
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])])
    start, group = np.flatnonzero(new), np.cumsum(new) - 1
    wid, kind = entry >> 2, entry & 3

    def least(where):
        return np.minimum.reduceat(np.where(where, wid, none), start)

    skips = np.add.reduceat((kind != _CUT).astype(np.int64), start)
    firsts = np.add.reduceat((kind == _FIRST_SKIP).astype(np.int64), start)
    cut, best_skip, best_first = least(kind == _CUT), least(kind != _CUT), least(kind == _FIRST_SKIP)
    second = least((kind != _CUT) & (wid != best_skip[group]))
    replaced = np.where(wid == best_skip[group], second[group], best_skip[group])
    shorter = np.where(kind == _FIRST_SKIP, cut[group], none)
    n = np.where(kind == _CUT, firsts[group], skips[group] - 1 + (shorter != none))
    best = np.where(kind == _CUT, best_first[group], np.minimum(replaced, shorter))
    some = n > 0
    return pa.RecordBatch.from_arrays([pa.array(wid[some]), pa.array(n[some]), pa.array(best[some])], names=["wid", "n_near", "best"])


def near_words(ranked: DataFrame) -> DataFrame:
    """ranked: (wid, word). Returns (wid, n_near, best): words with near words, best the near word of least id."""
    ahead, ahead_aliases = trie(ranked)
    back, back_aliases = trie(ranked.select("wid", F.reverse("word").alias("word")))
    both = ahead.withColumnRenamed("nodes", "ahead").join(back.select("wid", F.col("nodes").alias("back")).hint("merge"), "wid")
    entries = both.select("wid", "word", "ahead", "back").mapInArrow(_enter(ahead_aliases, back_aliases), "p long, s long, entry long")
    met = entries.repartition("p", "s").sortWithinPartitions("p", "s", "entry").mapInArrow(_meet, "wid long, n_near long, best long")
    return met.groupBy("wid").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """forms: stored (wid, form). Returns (wid, root): where the forms lead in the end."""
    now = forms.select("wid", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        joined = store.keep(now.join(ahead.hint("merge"), "root", "left").select("wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = joined.select("wid", "root")
        if not joined.filter("moved").limit(1).count():
            return now


def variants(counts: DataFrame) -> DataFrame:
    """counts: (word, n) of distinct words. Returns word, form, root, n, n_near and form_n."""
    ranked = counts.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("wid"), "word", "n")
    ranked = store.keep(ranked, "ranked")
    near = store.keep(near_words(ranked.select("wid", "word")), "near-words")
    other = ranked.select(F.col("wid").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = ranked.join(near.hint("merge"), "wid", "left").join(other.hint("merge"), "best", "left")
    chosen = F.col("form_n") >= F.col("n") * FORM_RATIO
    found = store.keep(
        found.select(
            "wid", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(chosen, F.col("best")).alias("form_wid"), F.when(chosen, F.col("form")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(store.keep(found.filter("form_wid IS NOT NULL").select("wid", F.col("form_wid").alias("form")), "form-links"))
    names = ranked.select(F.col("wid").alias("root"), F.col("word").alias("root_word"))
    roots = roots.join(names.hint("merge"), "root").select("wid", "root_word")
    return found.join(roots.hint("merge"), "wid", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11(spark, sf_dir: str) -> DataFrame:
    return variants(word_counts(store.table(spark, sf_dir, "documents"), rule=slipped))
