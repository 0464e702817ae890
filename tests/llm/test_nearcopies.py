"""The near-copy stage on planted copies, against all pairs."""

import itertools
import random

from pyspark.sql import functions as F

from trustflow.llm import nearcopies, simhash, store

SCHEMA = "doc_id long, text string"


def plain_shingles(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def similarity(a, b):
    a, b = plain_shingles(a), plain_shingles(b)
    return len(a & b) / len(a | b)


def planted(rng):
    """Texts, each with copies in which up to 8 % of the words are others."""
    rows = []
    for base in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 80, 250, 900]))]
        rows.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 2, 12])):
            copy = list(words)
            for _ in range(round(len(words) * rng.choice([0.005, 0.015, 0.02, 0.03, 0.08]))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(copy))
    return rows


def kept_by_all_pairs(rows):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if similarity(rows[i], rows[j]) >= 0.8:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i for i in range(len(rows)) if find(i) == i}


def test_planted_near_copies_go_and_others_stay(spark):
    rows = planted(random.Random(11))
    pairs = [p for p in itertools.combinations(rows, 2) if similarity(*p) >= 0.8 and p[0] != p[1]]
    far = sum((simhash.fingerprint(a.encode()) ^ simhash.fingerprint(b.encode())).bit_count() > 2 for a, b in pairs)
    assert far > 20  # out of reach of two bits
    df = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == kept_by_all_pairs(rows)


def test_threshold_is_exact():
    a = [b"%d" % i for i in range(49)]  # 45 shingles
    assert nearcopies.similar(nearcopies.shingles(a), nearcopies.shingles(a[:40]))  # 36 of 45
    assert not nearcopies.similar(nearcopies.shingles(a), nearcopies.shingles(a[:39]))
    assert not nearcopies.similar(set(), set())


def one_group(n, words, seed):
    """Copies of one text, each with words of its own: most pairs are alike, but below 0.8."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    rows = []
    for _ in range(n):
        copy = list(base)
        for i in sorted(rng.sample(range(words), rng.randint(1, words // 20)), reverse=True):
            copy[i : i + 1] = rng.choice([[f"x{rng.randrange(10**7)}"], [], [copy[i], f"y{rng.randrange(10**7)}"], [f"z{rng.randrange(3)}"]])
        rows.append(" ".join(copy))
    return rows


def keyed(spark, rows):
    df = store.keep(spark.createDataFrame(list(enumerate(rows)), "rid long, text string"), "t")
    signs = store.keep(nearcopies.signed(df.select("rid", F.col("rid").alias("id"), F.lit(0).cast("long").alias("tie"), "text")), "s")
    return df, signs


def test_large_group_of_texts_alike_is_whole(spark):
    rows = one_group(220, 150, 3) + one_group(60, 40, 4) + planted(random.Random(5))[:60]
    near = sum(similarity(a, b) >= 0.8 for a, b in itertools.combinations(rows[:220], 2))
    assert 0.05 < near / (220 * 219 / 2) < 0.7
    df, signs = keyed(spark, rows)
    for small in (8, nearcopies.SMALL):
        labels = {r.key: r.label for r in nearcopies.groups(signs, df, small).collect()}
        kept = {i for i, t in enumerate(rows) if labels[nearcopies.key_of(nearcopies.words_of(t.encode()))] == i}
        assert kept == kept_by_all_pairs(rows)


def test_work_in_a_large_group_is_linear(spark):
    """Texts of one group, of which hardly any are near copies: their buckets hold all pairs, the filters leave few."""
    for n in (300, 900):
        rng = random.Random(n)
        base = [f"w{i}" for i in range(120)]
        rows = []
        for _ in range(n):
            copy = list(base)
            for i in rng.sample(range(0, 120, 5), rng.randint(5, 8)):
                copy[i] = f"x{rng.randrange(10**7)}"
            rows.append(" ".join(copy))
        df, signs = keyed(spark, rows)
        nodes = store.keep(signs.select(F.col("rid").alias("node"), "buckets"), "n")
        found = nearcopies.members(nodes)
        at = nearcopies.open_members(found, spark.createDataFrame([], "node long, label long"))
        all_pairs = found.groupBy("bucket").agg((F.count("*") * (F.count("*") - 1) / 2).alias("p")).agg(F.sum("p")).first()[0]
        first = nearcopies.first_pairs(found).count()
        others = nearcopies.large_pairs(at, df.select(F.col("rid").alias("node"), "text")).count()
        assert first <= 2 * nearcopies.BANDS * n  # two for each member of a bucket
        assert others <= n < all_pairs / 20


def test_fingerprints_alone_link_what_lies_within_two_bits(spark, monkeypatch):
    """Without any min-hash bucket the stage still finds the near copies that SimHash can reach."""
    rng = random.Random(23)
    rows, close = [], set()
    for _ in range(30):
        words = [f"w{rng.randrange(3000)}" for _ in range(400)]
        copy = [*words[:-1], "x"]
        marks = [simhash.fingerprint(" ".join(w).encode(), nearcopies.SHINGLE_WORDS) for w in (words, copy)]
        if (marks[0] ^ marks[1]).bit_count() <= 2:
            close.add(len(rows) + 1)
        rows += [" ".join(words), " ".join(copy)]
    assert len(close) > 5
    bucketless = nearcopies.members
    monkeypatch.setattr(nearcopies, "members", lambda nodes: bucketless(nodes.filter("false")))
    df = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == set(range(len(rows))) - close


def test_candidates_hold_every_linked_fingerprint_together(spark):
    nodes = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 3), (5, -1), (6, 1 << 40), (7, 0xFF00)], "node long, fp long")
    pairs = {(r.a, r.b) for r in simhash.candidates(store.keep(nodes, "n")).collect()}
    assert {(1, 2), (2, 3), (1, 4), (1, 6)} <= pairs and not {5, 7} & {x for p in pairs for x in p}
