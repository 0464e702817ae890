"""Tiles and recursion against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from trustflow.llm import collocations
from trustflow.llm.collocations import Sizes


def plain(rows, least=100, best=2000):
    """rows: (text, lang)."""
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        big = {p: f for p, f in found.items() if f >= least}
        hidden = set()
        for p, f in big.items():
            for k in range(2, len(p)):
                hidden |= {q for i in range(len(p) - k + 1) if f >= big[q := p[i : i + k]]}
        rows = []
        for p, a in big.items():
            if len(p) > 1 and p not in hidden:
                cuts = [(1000 * a * total[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i, p.decode(), -a, lft, r, total[lang], -s) for i, (s, a, p, lft, r) in enumerate(sorted(rows)[:best], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made_up(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "a", "new", "york", "city", "Hall", "\x00x", "ñandú", "日本", "x.y", "it's", "-"]
    weights = [30, 20, 8, 8, 6, 5, 2, 4, 3, 2, 2, 1]
    fixed = ["in New York City hall", "out of the blue sky", "one\ttwo  three four five six", "\x00x ñandú"]
    rows = []
    for _ in range(n):
        parts = [" ".join(rng.choices(words, weights, k=rng.randint(0, 9))) if rng.random() < 0.7 else rng.choice(fixed) for _ in range(rng.randint(0, 12))]
        rows.append((rng.choice([" ", ". ", "\n", "!?", "; "]).join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize(("seed", "least", "sizes"), [(1, 5, Sizes()), (2, 3, Sizes(300, 2, 64, 1, 64, 0)), (3, 8, Sizes(1, 4, 2, 1 << 20, 1 << 10, 4))])
def test_all_phrases(spark, seed, least, sizes):
    rows = made_up(seed) + [(None, "en"), ("", "fr")]
    want = plain(rows, least)
    assert max(len(r[2].split(" ")) for r in want) == 5 and {r[0] for r in want} == {"en", "fr", "und"}
    assert got(collocations.collocations(spark.createDataFrame(rows, "text string, lang string"), min_count=least, sizes=sizes)) == want


@pytest.mark.parametrize("sizes", [Sizes(), Sizes(tile=4, fill=1), Sizes(tile=4, fill=1 << 30), Sizes(tile=16, dense_tiles=3, fill=4)])
def test_tiles_count_every_pair_once(sizes):
    rng = np.random.default_rng(4)
    codes = np.minimum(rng.zipf(1.3, 20_000), 5000).astype(np.int64) - 2
    want = Counter((a, b) for a, b in zip(codes[:-1].tolist(), codes[1:].tolist(), strict=True) if a >= 0 and b >= 0)
    keys, counts = collocations.count_pairs(codes, sizes)
    assert {(k >> 32, k & 0xFFFFFFFF): n for k, n in zip(keys.tolist(), counts.tolist(), strict=True)} == want
    assert (np.diff(keys) > 0).all()


def test_best_of_each_language_and_ties(spark):
    rows = [(f"a{i} b{i} " * 1 + ". ", lang) for i in range(6) for lang in ("en", "de") for _ in range(100)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert got(collocations.collocations(df, best=4)) == plain(rows, best=4)


def test_repeats_clashing_columns_and_empty_table(spark):
    rows = [("red fox. ", "en", "x", 1, 2)] * 100
    df = spark.createDataFrame(rows, "text string, lang string, words string, block int, n int")
    assert got(collocations.collocations(df)) == [("en", 1, "red fox", 100, 100, 100, 200, 2000)]
    assert collocations.collocations(df.limit(0)).count() == 0


def test_very_long_piece_and_text(spark):
    rows = [("one two three " * 200_000, "en"), ("four five. " * 300_000, "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert got(collocations.collocations(df, sizes=Sizes(block_bytes=10_000))) == plain(rows)


def test_products_beyond_64_bits(spark):
    f = 10**13
    row = spark.range(1).selectExpr(f"cast({f} as long) a", f"cast({50 * f} as long) t", f"cast({2 * f} as long) l")
    score = row.selectExpr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(t as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(l as decimal(19,0))) s")
    assert score.first().s == 1000 * f * 50 * f // (2 * f) ** 2
