"""Toxic documents: misspelled terms of a learned lexicon, weighed by their surroundings.

1. Lexicon. Of a bounded sample of labelled training rows (``SAMPLE_ROWS``, least hashes of the
   id first), the words that toxic documents hold far more often than others, each with its log odds.
2. Automaton. The lexicon is a trie; its nodes paired with 0 or 1 errors are the states of a
   Levenshtein automaton. Sets of such states are made on demand, so a word costs one lookup for each
   character and most words die after two or three. Terms under ``FUZZY_LENGTH`` letters allow no error,
   a misspelled hit counts half, and words that clean documents of the sample hold are no misspellings.
3. Context. A window of ``CONTEXT`` characters around each hit says whether it stands in quotation marks
   or beside a verb of reporting (quotation), and whether it addresses someone (abuse).
4. Score. A logistic regression over the sums of direct, quoted and addressed hits, fitted
   on the same sample; every document is scored over its whole text.

Labels of held-out rows (crc32 of the id as text, mod 5, is 0) are never read. Language, source and id are no inputs.

Defined results: null and empty texts have no hits and get the score of that. Repeated ids are scored
row by row; of repeated labels the highest counts; null labels count for nothing. A null id is not held out.
Without both classes in the training rows every score is the smoothed share of toxic rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import DataFrame, functions as F, types as T

from trustflow.llm import store

SAMPLE_ROWS = 20_000
FUZZY_LENGTH = 5
CONTEXT = 48
FOLDS = 5
MISSPELLED = 0.5  # weight of a misspelled hit
FEATURES = ("direct", "quoted", "addressed", "terms", "density")
#: Marks and words that show quotation or address in four languages.
QUOTES = "\"“”„«»‘’"
REPORTING = frozenset("said says wrote writes called quote quoted sagte schrieb nannte zitat dit écrit appelé cité dijo escribió llamó cita".split())
ADDRESS = frozenset("you your you're u du dich dir dein ihr tu te toi vous votre tú ti usted ustedes".split())

#: Letters and digits of any script, with the marks that combine with them.
WORD = re.compile("(?:[^\\W_]+[\u0300-\u036f]*)+")
_ASCII = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(128)) + b" " * 128


def words_of(text: str | None) -> list[str]:
    lower = text.lower() if text else ""
    return lower.encode().translate(_ASCII).decode().split() if lower.isascii() else WORD.findall(lower)


class Lexicon:
    """terms: {term: weight}. match(word) gives (weight, errors) of the best term, or None.
    words: known words that are no misspellings of a term."""

    def __init__(self, terms: dict[str, float], words: frozenset[str] = frozenset(), fuzzy_length: int = FUZZY_LENGTH):
        self.words = words
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[float, int] | None] = [None]  # weight, errors allowed
        for term, weight in terms.items():
            node = 0
            for ch in term:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                node = self.children[node][ch]
            self.ends[node] = (weight, int(len(term) >= fuzzy_length))
        self.letters = {ch for c in self.children for ch in c}
        self.sets: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.step: list[dict[str, int]] = []
        self.result: list[tuple[float, int] | None] = []
        self.start = self._enter({(0, 0)})

    def _enter(self, states: set) -> int:
        """The number of a set of (node, errors), once missing letters are allowed for; -1 if empty."""
        states |= {(child, 1) for node, errors in states if not errors for child in self.children[node].values()}
        key = frozenset(s for s in states if not s[1] or (s[0], 0) not in states)
        if not key:
            return -1
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.step.append({})
            ended = [(errors, -self.ends[n][0]) for n, errors in key if self.ends[n] and errors <= self.ends[n][1]]
            self.result.append((-min(ended)[1], min(ended)[0]) if ended else None)
        return self.number[key]

    def _move(self, at: int, ch: str) -> int:
        out: set = set()
        for node, errors in self.sets[at]:
            child = self.children[node].get(ch)
            if child is not None:
                out.add((child, errors))
            if not errors:
                out.add((node, 1))  # a letter too many
                out.update((c, 1) for c in self.children[node].values())  # another letter
        self.step[at][ch] = to = self._enter(out)
        return to

    def match(self, word: str) -> tuple[float, int] | None:
        at, step = self.start, self.step
        for ch in word:
            to = step[at].get(ch)
            if to is None:
                if ch not in self.letters:
                    ch = "\0"  # all letters that no term has are alike
                    to = step[at].get(ch)
                if to is None:
                    to = self._move(at, ch)
            if to < 0:
                return None
            at = to
        found = self.result[at]
        return found if found is None or not found[1] or word not in self.words else None


def _contexts(lower: str, hits: dict[str, tuple[float, int]]) -> dict[str, list[int]]:
    """Occurrences of each hit: in quotation, in address, and all. One pass over the text."""
    out = {word: [0, 0, 0] for word in hits}
    for m in WORD.finditer(lower):
        if (counts := out.get(m[0])) is None:
            continue
        left, right = lower[max(0, m.start() - CONTEXT) : m.start()], lower[m.end() : m.end() + CONTEXT]
        near = {*words_of(left), *words_of(right)}
        marked = any(sum(left.count(q) for q in pair) % 2 and any(q in right for q in pair) for pair in ('"', "“”„", "«»", "‘’"))
        counts[0] += bool(marked or near & REPORTING)
        counts[1] += bool(near & ADDRESS)
        counts[2] += 1
    return out


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    words = words_of(text)
    match = lexicon.match
    hits = {w: r for w in sorted(set(words)) if (r := match(w)) is not None}
    direct = quoted = addressed = terms = 0.0
    if hits:
        contexts = _contexts(text.lower(), hits)
        for word, (weight, errors) in hits.items():
            q, a, n = contexts[word]
            share = MISSPELLED**errors
            direct += share * weight * (1 - q / n)
            quoted += share * weight * q / n
            addressed += share * weight * a / n
            terms += share
    return [
        math.log1p(direct), math.log1p(quoted), math.log1p(addressed), math.log1p(terms),
        math.log1p(100.0 * terms / max(1, len(words))),
    ]


def _features(terms: dict[str, float], words: frozenset[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, words)
        for batch in batches:
            row = batch.column("row")
            values = [features(t.as_py(), lexicon) for t in row.field(text_col)]
            yield pa.RecordBatch.from_arrays([row, pa.array(values, pa.list_(pa.float64()))], names=["row", "x"])

    return run


def with_features(documents: DataFrame, terms: dict[str, float], words: frozenset[str], text_col: str = "text") -> DataFrame:
    rows = documents.select(F.struct("*").alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(_features(terms, words, text_col), schema)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled training rows, those with the least hashes of the id."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    # At most ``limit`` pairs of numbers go to each executor.
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word, by label, over a task's share of the bounded sample."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic"), strict=True):
            (toxic if label.as_py() else clean).update(set(words_of(text.as_py())))
    words = list({*toxic, *clean})
    yield pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()), pa.array([clean[w] for w in words], pa.int64())],
        names=["word", "in_toxic", "in_clean"],
    )


def _near(terms: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            near = [w for w in batch.column("word").to_pylist() if w not in terms and lexicon.match(w)]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["word"])

    return run


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int):
    """Terms with their log odds: in five toxic rows or more, at least twenty times as likely there, and
    beyond what chance gives (z of 3), all that there are. Then the clean words of the sample that resemble a term.
    Both come to the driver; both are part of the words of the bounded sample."""
    counts = sample.mapInArrow(_word_counts, "word string, in_toxic long, in_clean long")
    counts = store.keep(counts.groupBy("word").agg(F.sum("in_toxic").alias("a"), F.sum("in_clean").alias("b")), "words")
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n_toxic - F.col("a") + 0.5)) - F.log(b / (n_clean - F.col("b") + 0.5))
    chosen = (
        counts.filter(F.col("a") >= 5)
        .select("word", odds.alias("weight"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
        .filter((F.col("weight") >= math.log(20)) & (F.col("z") >= 3))
    )
    terms = {r.word: float(r.weight) for r in sorted(chosen.collect(), key=lambda r: r.word)}
    near = counts.filter("b > 0").select("word").mapInArrow(_near(terms), "word string")
    return terms, frozenset(r.word for r in near.collect())


class Model:
    """score(documents) gives ``row`` and ``score``."""

    def __init__(self, terms: dict[str, float], words: frozenset[str], weights: list[float], bias: float):
        self.terms, self.words, self.weights, self.bias = terms, words, weights, bias

    def score(self, documents: DataFrame, text_col: str = "text") -> DataFrame:
        x = with_features(documents, self.terms, self.words, text_col)
        dot = F.lit(float(self.bias))
        for i, w in enumerate(self.weights):
            dot = dot + F.col("x")[i] * float(w)
        return x.select("row", (1 / (1 + F.exp(-dot))).alias("score"))


def fit(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> Model:
    sample = store.keep(training_sample(documents, labels, limit), "toxic-sample")
    n = {r.toxic: r["count"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, frozenset(), [0.0] * len(FEATURES), math.log((n_toxic + 1) / (n_clean + 1)))
    sample = sample.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    terms, words = learn_lexicon(sample, n_toxic, n_clean)
    x = store.keep(
        with_features(sample, terms, words).select(array_to_vector("x").alias("features"), F.col("row.toxic").cast("double").alias("label")),
        "toxic-features",
    )
    # Hits never speak for a text.
    floor = Matrices.dense(1, len(FEATURES), [0.0] * len(FEATURES))
    model = LogisticRegression(regParam=1e-3, maxIter=50, lowerBoundsOnCoefficients=floor).fit(x)
    return Model(terms, words, [float(w) for w in model.coefficients], float(model.intercept))


def drop_toxic(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that score under a half, with their own columns."""
    return fit(documents, labels, limit).score(documents).filter("score < 0.5").select("row.*")


def op9(spark, sf_dir: str) -> DataFrame:
    documents = store.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = fit(documents, store.table(spark, sf_dir, "labels")).score(documents)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
