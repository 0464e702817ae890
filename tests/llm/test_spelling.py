"""Trie-node pairs against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from trustflow.llm import spelling, store


def plain_counts(rows, slip=True):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, all_pairs=True):
    words = sorted(counts)
    by = {w: [] for w in words}
    if all_pairs:
        for i, a in enumerate(words):
            for b in words[:i]:
                if near(a, b):
                    by[a].append(b)
                    by[b].append(a)
    else:  # each string one deletion away, then the definition itself
        keys = {}
        for w in words:
            for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
                keys.setdefault(k, []).append(w)
        pairs = {(a, b) for group in keys.values() for a in group for b in group if a < b}
        for a, b in pairs:
            if near(a, b):
                by[a].append(b)
                by[b].append(a)
    form = {}
    for w in words:
        best = min(by[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(by[w]), counts[form[w]] if form[w] else None) for w in words}


def tuples(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_registered_query_is_the_brute_force(spark, sf_dir):
    rows = store.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = spelling.op11(spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_counts(rows), all_pairs=False)
    assert len(want) > 500 and any(w[1] for w in want)
    assert tuples(got) == want


@pytest.mark.parametrize("seed", range(2))
def test_all_pairs_of_dense_words_over_many_tasks(spark, seed):
    rng = random.Random(seed)
    counts = {"".join(rng.choice("aab") for _ in range(rng.randint(6, 8))): rng.choice([5, 5, 6, 25, 40, 125, 700]) for _ in range(400)}
    counts |= {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 151, "àaaaaaa": 5, "aaaaaaÿ": 5, "bbbbbb": 99}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # Many small tasks: prefixes go on from one to the next, over several.
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert tuples(spelling.variants(df)) == plain_variants(counts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_chains_lead_to_the_last_form(spark):
    counts = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefghi": 625, "abcdefghij": 3125}
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert {r.root for r in got.values()} == {"abcdefghij"}
    assert [got[w].form_n for w in sorted(counts)] == [25, 125, 625, 3125, None]


def test_nulls_empty_repeats_and_clashing_columns(spark):
    rows = [(1, None, 1, 1), (2, "", 1, 1), (None, "Wörter wörter. WÖRTER; " * 4, 1, 1), (None, "Wörter wörter. WÖRTER; " * 4, 1, 1), (4, "worter", 1, 1)] + [(9, "worter x", 1, 1)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, word long, n long")
    got = tuples(spelling.variants(spelling.word_counts(df, rule=spelling.slipped)))
    assert got == plain_variants(plain_counts([(r[0], r[1]) for r in rows]))
    assert {w[0] for w in tuples(spelling.variants(spelling.word_counts(df)))} == {"wörter", "wÖrter", "worter"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.word_counts(df)).count() == 0


def test_very_long_texts_and_words(spark):
    long = "ab" * 3000
    rows = [(i, f"{long} {long}x " + "filler " * 100_000) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = tuples(spelling.variants(spelling.word_counts(df)))
    assert got == {(long, None, long, 5, 1, None), (long + "x", None, long + "x", 5, 1, None), ("filler", None, "filler", 500_000, 0, None)}
