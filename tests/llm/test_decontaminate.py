"""Benchmark passages against a brute-force version, and the defined cases."""

import hashlib
import random
import re

from trustflow.llm import decontaminate as d

WORDS = "alpha beta gamma delta of the and to ä x1 zeta eta".split()


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items, window=13):
    out = []
    for doc_id, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for item_id, passage in items:
            w = plain_words(passage)
            m = min(window, len(w))
            for i in range(len(w) - m + 1) if m else ():
                for p in range(len(words) - m + 1):
                    if words[p : p + m] == w[i : i + m]:
                        hit.update(range(p, p + m))
                        if item_id is not None:
                            found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def run(spark, docs, items, **options):
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = d.report(documents, benchmark, **options)
    return [tuple(r) for r in out.select("row.doc_id", *out.columns[1:]).collect()]


def key(rows):
    return sorted(rows, key=str)


def test_random_texts_in_one_block_and_in_many(spark):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.choice([1, 2, 3, 7, 13, 14, 30])))) for i in range(25)]
    items += [(None, "beta beta beta beta"), (3, items[3][1]), (70, None), (71, " -- "), (72, items[5][1])]
    docs = []
    for i in range(120):
        words = rng.choices([*WORDS, *(f"w{k}" for k in range(60))], k=rng.randint(0, 80))
        if i % 3 == 0:
            words[5:5] = plain_words(rng.choice(items[:25])[1])
        docs.append((i, " ".join(words).title()))
    docs += [(None, None), (200, ""), (201, "\t--\n"), (5, docs[5][1])]
    want = key(plain(docs, items))
    assert key(run(spark, docs, items)) == want
    assert key(run(spark, docs, items, block_chars=300)) == want


def test_one_long_text(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    docs = [(1, " ".join(words))]
    items = [(i, " ".join(words[p : p + 40])) for i, p in enumerate((0, 777, 59_960))]
    assert run(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]


def test_stage_keeps_columns_and_clean_documents(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(1, passage, 1, "x"), (2, "clean " * 30, 2, "y"), (3, passage + " fill" * 381, 3, "z"), (4, None, 4, "n")],
        "doc_id long, text string, n_words int, row string",
    )
    kept = d.drop_contaminated(docs, spark.createDataFrame([(9, passage)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
