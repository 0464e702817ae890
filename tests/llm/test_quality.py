"""Counts and verdicts of the quality rules against a brute-force version."""

import random
import re

from trustflow.llm import quality as q, store


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    repeated = {p for i, w in enumerate(windows) if seen[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def texts():
    rng = random.Random(3)
    words = ["a", "b", "c", "the", "é😀", "x|y", "#", "\x1f", "\xa0"]
    out = ["".join(rng.choice(words) + rng.choice([" ", "\n", "\t", "  ", "\r\n", "\x0b", "\x0c"]) for _ in range(rng.randint(0, 90))) for _ in range(250)]
    return [*out, None, "", " \n ", "one two", "a a a a", "same line\nsame line\n\n\nsame line", "w " * 40_000]


def rows(df, key="doc_id"):
    return {r.row[key]: tuple(r[m] for m in (*q.METRICS, "base_failed")) for r in df.collect()}


def test_counts_on_noise(spark):
    cases = texts()
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = rows(q.judge(df, list(q.RULES)))
    for i, text in enumerate(cases):
        assert got[i] == plain(text), text and text[:80]


def test_registered_query(spark, sf_dir):
    got = {r.doc_id: r for r in q.op2(spark, sf_dir).collect()}
    for r in store.table(spark, sf_dir, "documents").collect():
        g = got[r.doc_id]
        assert tuple(g[m] for m in (*q.METRICS, "base_failed")) == plain(r.text)
        assert not (g.base_failed and g.kept)


def test_verdict_does_not_depend_on_the_order(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    orders = [list(q.RULES), list(q.RULES)[::-1], q.plan(df)]
    kept = [{r.row.doc_id: r.kept for r in q.judge(df, o).collect()} for o in orders]
    assert kept[0] == kept[1] == kept[2]
    assert {r.name for r in orders[2]} == {r.name for r in q.RULES}


def test_clean_prose_stays_and_junk_goes(spark):
    clean = "\n".join(f"Word{i} stands beside other{i} and number{i}." for i in range(40))
    junk = " ".join(f"w{i}***" for i in range(100))
    shout = " ".join(f"LOUD{i} WORDS" for i in range(60))
    df = spark.createDataFrame([(1, clean, "x"), (2, junk, "y"), (3, shout, "z")], "doc_id long, text string, n_words string")
    got = {r.row.doc_id: (r.kept, r.base_failed) for r in q.judge(df, list(q.RULES)).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (False, False)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert q.judge(df, q.plan(df)).count() == 0
