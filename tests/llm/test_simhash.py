"""SimHash fingerprints and components against a brute-force version."""

import random
import re

import pytest
import xxhash

from pyspark.sql import types as T
from trustflow.llm import simhash, store
from trustflow.llm.components import components

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """Least position that each position reaches over links of at most two bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_registered_query_is_the_brute_force(spark, sf_dir):
    rows = sorted(store.table(spark, sf_dir, "documents").select("doc_id", "text").collect())
    fps = [plain_fingerprint(r.text) for r in rows]
    want = {
        (r.doc_id, f"{fp:016x}", rows[g].doc_id) for r, fp, g in zip(rows, fps, plain_groups(fps), strict=True)
    }
    assert {tuple(r) for r in simhash.op5(spark, sf_dir).collect()} == want


def test_links_of_two_bits_and_chains(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = [base, base ^ 1, base ^ 0b111, base ^ (1 << 40) ^ 0b111, base ^ (1 << 63) ^ (1 << 31)]
    fps += [base ^ (0b1111 << 20), 0, 3, 7 << 50, *(rng.getrandbits(64) for _ in range(200))]
    for _ in range(150):  # a dense group of near copies
        f = 0xAAAA5555AAAA5555
        for b in rng.sample(range(64), rng.randint(0, 4)):
            f ^= 1 << b
        fps.append(f)
    df = spark.createDataFrame([(i, signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.groups(df).collect()}
    want = plain_groups(fps)
    assert [got[signed(f)] for f in fps] == want


def test_nulls_empty_repeats_and_clashing_columns(spark):
    rows = [(3, None, "a", 1), (1, "", "b", 2), (1, "", "b", 2), (None, "  \t\n", "c", 3), (7, "Å word", "d", 4), (8, "Å WORD", "e", 5), (None, "none like it at all", "f", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, row long")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.fp) for r in kept.collect()) == [(-1, "f"), (1, "b"), (7, "d")]
    marked = store.keep(simhash.fingerprints(df).select("row.doc_id", "fp"), "t")
    assert {r.component_id for r in simhash.groups(marked).collect()} == {1, 7, None}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.keep_one(df).count() == 0
    marked = store.keep(simhash.fingerprints(df).select("row.doc_id", "fp"), "t")
    assert simhash.groups(marked).count() == 0


def test_long_text_is_read_whole():
    text = " ".join(f"w{i % 977} x{i % 991}" for i in range(60_000))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in "ab"])
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, schema)).collect()}
    root = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in range(120):
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
