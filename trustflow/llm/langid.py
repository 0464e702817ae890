"""Language of a text by rank-order profiles and their out-of-place distance.

1. A text is read code point by code point: letters in lower case, all else one blank. Its n-grams have one to three code
   points of a word and the blanks around it; none spans two words and a single blank is none.
2. A profile lists n-grams from the most frequent on (equal counts: by code points), ``PROFILE`` at most. A language's profile
   counts all training texts whole; counts are summed in each task before they are shuffled, so no language gathers in one.
3. A document's distance to a language is the sum over its profile of how many places an n-gram is out of place there, and
   ``PROFILE`` for one that the language's profile lacks. The least distance wins; ties go to the language least in code points.
   The score is 1 - distance / (PROFILE * n-grams of the document's profile).

Defined results: a null or empty text, and one without a letter, is ``und`` with score 0; so is every text if nothing was
learned. Rows without a language teach nothing. Repeated rows teach once each and are all answered. Whole texts count,
in pieces of bounded length. What tasks receive is languages x PROFILE numbers; more than ``MAX_LANGUAGES`` is an error.
Columns of other names pass through; two columns named like the results are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from trustflow.llm import store

PROFILE = 400
MAX_LANGUAGES = 10_000
UNKNOWN = "und"
HELD_OUT_FOLDS, HELD_OUT_FOLD = 3, 1
_PIECE = 1 << 20  # code points read at once
_BITS = 21  # of a code point
_BLANK = 32


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a blank."""
    table = np.full(0x110000, _BLANK, dtype=np.uint32)
    for i in range(len(table)):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _codes(text: str) -> np.ndarray:
    return _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")].astype(np.int64)


def _grams(text: str) -> Iterator[np.ndarray]:
    """All n-grams of a text as numbers, piece by piece."""
    tail = np.array([_BLANK], dtype=np.int64)
    for i in range(0, len(text) + 1, _PIECE):
        part = text[i : i + _PIECE]
        codes = np.concatenate([tail, _codes(part)] + ([[_BLANK]] if i + _PIECE > len(text) else []))
        fresh = np.ones(len(codes), dtype=bool)
        fresh[: len(tail)] = False
        blank = codes == _BLANK
        some = ~(blank & np.concatenate([[False], blank[:-1]]))
        codes, blank, fresh = codes[some], blank[some], fresh[some]
        pair = codes[:-1] << _BITS | codes[1:]
        yield np.concatenate(
            [codes[fresh & ~blank], pair[fresh[1:]], (codes[:-2] << 2 * _BITS | pair[1:])[fresh[2:] & ~blank[1:-1]]]
        )
        tail = codes[-2:]


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a whole text in ascending order, and how often each occurs."""
    parts = [np.unique(g, return_counts=True) for g in _grams(text)]
    if len(parts) == 1:
        return parts[0]
    return _sum(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def profile(text: str) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first."""
    grams, counts = gram_counts(text)
    return grams[np.lexsort((grams, -counts))[:PROFILE]]


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    size: dict[str, int] = {}

    def counted(lang):
        # Texts are set apart by a line end, which is no letter, so no n-gram spans two of them.
        grams, counts = gram_counts("\n".join(held.pop(lang)))
        size.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] > 4 * _PIECE:
                yield counted(lang)
        if sum(size.values()) > 16 * _PIECE:
            yield from [counted(x) for x in list(held)]
    yield from [counted(x) for x in list(held)]


def profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, gram) of each language of the labelled rows; rank from 0."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_tally, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", rank - 1).filter(F.col("rank") < PROFILE).select("lang", "rank", "gram")


def _table(learned: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, all their n-grams in ascending order, and a place for each n-gram (row) and language (column)."""
    learned = store.keep(learned, "profiles")
    n = learned.agg(F.count_distinct("lang")).first()[0]
    if n > MAX_LANGUAGES:
        raise ValueError(f"{n} languages; at most {MAX_LANGUAGES} are held at once")
    rows = learned.collect()  # languages x PROFILE rows
    langs = sorted({r.lang for r in rows})
    grams = np.unique(np.array([r.gram for r in rows], dtype=np.int64))
    places = np.full((len(grams) + 1, len(langs)), PROFILE, dtype=np.int16)
    column = {x: i for i, x in enumerate(langs)}
    for r in rows:
        places[np.searchsorted(grams, r.gram), column[r.lang]] = r.rank
    return langs, grams, places


def guess(text: str | None, langs: list[str], grams: np.ndarray, places: np.ndarray) -> tuple[str, float]:
    own = profile(text) if text and langs else ()
    if not len(own):
        return UNKNOWN, 0.0
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    there = places[np.where(grams[at] == own, at, len(grams))]
    away = np.where(there == PROFILE, PROFILE, np.abs(there - np.arange(len(own), dtype=np.int16)[:, None])).sum(axis=0, dtype=np.int64)
    best = int(np.argmin(away))
    return langs[best], 1.0 - float(away[best]) / (PROFILE * len(own))


def predict(rows: DataFrame, learned: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``. learned: what ``profiles`` gave."""
    langs, grams, places = _table(learned)
    rows = rows.drop("lang_pred", "score")
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, len(batch), 512)):
                found = [guess(t.as_py(), langs, grams, places) for t in part.column(text_col)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                    names=[*part.schema.names, "lang_pred", "score"],
                )

    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning; a null id never is."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % HELD_OUT_FOLDS == HELD_OUT_FOLD


def op13(spark, sf_dir: str) -> DataFrame:
    documents = store.table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    learned = profiles(documents.filter(~F.col("held_out")))
    return predict(documents.select("doc_id", "held_out", "text"), learned).select("doc_id", "held_out", "lang_pred", "score")
