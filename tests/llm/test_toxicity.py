"""The automaton against edit distance, and the classifier on held-out rows."""

import os
import random
import time
import zlib

import pytest
from pyspark.sql import functions as F
from trustflow.llm import store, toxicity as t


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_is_edit_distance_one():
    rng = random.Random(4)
    terms = {"".join(rng.choices("abé", k=rng.randint(3, 7))): float(i + 1) for i in range(25)}
    lexicon = t.Lexicon(terms)
    words = {"".join(rng.choices("abéz", k=rng.randint(1, 8))) for _ in range(4000)} | set(terms)
    for w in words:
        near = [(d, -v) for term, v in terms.items() if (d := distance(w, term)) <= (len(term) >= t.FUZZY_LENGTH)]
        assert lexicon.match(w) == ((-min(near)[1], min(near)[0]) if near else None), w


def test_quotation_and_known_words():
    lexicon = t.Lexicon({"moron": 8.0}, frozenset({"moran"}))
    at = dict(zip(t.FEATURES, t.features("you are a moron", lexicon), strict=True))
    quoted = dict(zip(t.FEATURES, t.features('he said "moron" there', lexicon), strict=True))
    wrong = dict(zip(t.FEATURES, t.features("such a morron", lexicon), strict=True))
    assert at["direct"] > wrong["direct"] > 0 and at["addressed"] > 0
    assert quoted["direct"] == 0 and quoted["quoted"] > 0
    assert not any(t.features("the moran case", lexicon)[:4]) and t.features(None, lexicon) == t.features("", lexicon)


def test_typographic_marks_are_no_letters():
    lexicon = t.Lexicon({"moron": 8.0, "né": 3.0})
    for text in ("a “moron” he", "«moron»", "¡moron!", "moron…", "moron—yes", "MORON's"):
        assert "moron" in t.words_of(text) and t.features(text, lexicon)[3] > 0, text
    assert t.words_of("Été x_y ne\u0301 日本 a1") == ["été", "x", "y", "ne\u0301", "日本", "a1"]
    assert t.words_of("plain Ascii-text_2") == t.WORD.findall("plain ascii-text_2")
    at = dict(zip(t.FEATURES, t.features("so “moron” it was", lexicon), strict=True))
    assert at["direct"] == 0 and at["quoted"] > 0


def test_all_terms_that_pass_are_kept(spark):
    """1,200 terms, some of two letters and one of 60; each in six toxic rows of its own."""
    terms = [f"t{i}" for i in range(1198)] + ["zq", "z" * 60]
    rows = [(" ".join(terms[k : k + 20]) + " shared", 1) for k in range(0, 1200, 20) for _ in range(6)]
    rows += [(f"shared calm c{i}", 0) for i in range(4000)]
    sample = spark.createDataFrame(rows, "text string, toxic int")
    found, _ = t.learn_lexicon(sample, 360, 4000)
    assert set(found) == set(terms)


def test_very_long_text_with_many_different_hits():
    lexicon = t.Lexicon({f"term{chr(97 + i // 26)}{chr(97 + i % 26)}": 4.0 for i in range(600)})
    text = " ".join(f"term{chr(97 + i % 600 // 26)}{chr(97 + i % 26)} words between" for i in range(60_000))
    start = time.perf_counter()
    assert t.features(text, lexicon)[0] > 0
    assert time.perf_counter() - start < 20


def corpus(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}" for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            words[10:10] = rng.sample(["wretched", "scoundrel", "villainous"], 2)
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic)))
    rows += [(9001, "mild words and a wretchd scoundrell together", "en"), (9002, None, "en"), (9003, "", "en"), (None, "plain words", "en"), (3, rows[3][1], "en")]
    labels += [(3, 1, 0), (None, 1, 1), (5, 0, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, x string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_and_catches_misspellings(spark):
    docs, labels = corpus(spark)
    model = t.fit(docs, labels)
    assert {"wretched", "scoundrel", "villainous"} <= set(model.terms)
    got = [(r.row.doc_id, r.row.text, r.score) for r in model.score(docs).collect()]
    assert len(got) == docs.count()
    for i, text, score in got:
        assert 0 <= score <= 1
        if i is not None and i < 600 and zlib.crc32(str(i).encode()) % 5 == 0:
            assert (score >= 0.5) == (i % 6 == 0), (i, text, score)
    by = {i: s for i, _, s in got}
    assert by[9001] >= 0.5 > max(by[9002], by[9003], by[None])
    kept = t.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id = 9001").count() == 0 and kept.filter("doc_id = 3").count() == 2


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark)
    flipped = labels.withColumn("toxic", F.when(t.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = t.fit(docs, labels), t.fit(docs, flipped)
    assert (a.terms, a.words, a.weights, a.bias) == (b.terms, b.words, b.weights, b.bias)


def test_registered_query(spark, sf_dir):
    rows = t.op9(spark, sf_dir).collect()
    assert len(rows) == store.table(spark, sf_dir, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_held_out_accuracy_on_a_given_table(spark):
    """Labels of held-out rows are only compared here; the query never reads them. Measured: 91 of 97 toxic and
    728 of 728 other rows are judged right; the six missed ones are junk text without a term in any spelling."""
    sf_dir = "/root/testdata/sf0.1"
    if not os.path.isdir(sf_dir):
        pytest.skip("no table of this size")
    truth = store.table(spark, sf_dir, "labels").filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    both = t.op9(spark, sf_dir).filter("held_out").join(truth, "doc_id")
    right = {r.toxic: (r.good, r.n) for r in both.groupBy("toxic").agg(F.count_if(F.col("predicted") == F.col("toxic")).alias("good"), F.count("*").alias("n")).collect()}
    assert right[1][1] > 20 and right[1][0] >= 0.93 * right[1][1], right
    assert right[0][0] >= 0.99 * right[0][1], right


def test_without_labels_or_documents(spark):
    docs, labels = corpus(spark)
    none = labels.limit(0)
    assert {round(r.score, 6) for r in t.fit(docs, none).score(docs).collect()} == {0.5}
    assert t.drop_toxic(docs.limit(0), labels).count() == 0
