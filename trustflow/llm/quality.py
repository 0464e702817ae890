"""Quality rules over whole texts, as a short-circuit cascade of built-in functions.

A rule is a condition over metrics of the text that rejects it. ``plan`` reads a bounded sample (``SAMPLE_ROWS``
rows), measures for each rule the time per row and the share of rows it rejects, and orders the rules by
rejection per cost. ``judge`` applies them as one CASE in that order: a later rule's expressions are not
computed for a row that an earlier one rejects. The verdict is the same in any order; sample and times decide
only the cost.

Defined results: null and empty texts have no words; all their counts are 0, and they fail the first base rule.
A metric that divides by the number of words is 0 without words. Repeated rows are judged each. An empty table
gives an empty result, its rules keep the given order.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from trustflow.llm import store
from trustflow.llm.patterns import let

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Rejects a text where ``rejects`` (over text and metrics) is true."""

    name: str
    rejects: str
    base: bool = False


#: The base rules are given; the others are the method's own, with limits common for web text.
RULES = (
    Rule("few_words", "n_words < 50", True),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", True),
    Rule("symbols", "n_symbols > 0.2 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 0.5 * n_lines"),
    Rule("letters", r"n_letter_words < 0.6 * n_words"),
    Rule("capitals", r"n_capital_words > 0.5 * n_words"),
    Rule("ellipsis", r"n_ellipsis_lines > 0.3 * n_lines"),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+", -1), "")


def repeated_words(word_array: Column) -> Column:
    """Words inside windows of three words that the text holds twice or more: equal windows are
    neighbours once the windows are sorted."""

    def covered(sorted_windows: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            return (x["s"] == F.get(sorted_windows, i - 1)["s"]) | (x["s"] == F.get(sorted_windows, i + 1)["s"])

        at = F.transform(F.filter(sorted_windows, lambda x, i: F.coalesce(twice(x, i), F.lit(False))), lambda x: x["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(places, lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("s"), i.alias("i")))

    return F.when(F.size(word_array) < 4, F.lit(0)).otherwise(let(F.sort_array(windows(word_array)), covered))


def _metric_columns(w: Column) -> dict[str, Column]:
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(w),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))),
        "n_repeat_words": repeated_words(w),
    }


#: Metrics that only the method's own rules read; computed where the cascade comes to them.
LAZY = {
    "n_lines": r"size(filter(split(_text, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]'))",
    "n_letter_words": r"regexp_count(_text, '(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D]*?\\p{L}')",
    "n_capital_words": r"regexp_count(_text, '(?<![^\\x20\\x09-\\x0D])\\p{Lu}{2,}+(?!\\p{Ll})')",
    "n_ellipsis_lines": r"regexp_count(_text, '(?:\\.\\.\\.|…)[\\x20\\t\\r]*(?:\n|\\z)')",
}


def with_metrics(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``_text`` (null as empty) and the metrics, as long."""
    rows = documents.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    # One lambda variable holds the words for both metrics that read them.
    names = list(_metric_columns(F.col("_text")))
    all_of = let(words(F.col("_text")), lambda w: F.struct(*(c.cast("long").alias(n) for n, c in _metric_columns(w).items())))
    return rows.withColumn("_m", all_of).select("row", "_text", *(F.col(f"_m.{n}").alias(n) for n in names))


def _condition(rule: Rule) -> Column:
    text = rule.rejects
    for name, expression in LAZY.items():
        text = text.replace(name, f"({expression})")
    return F.coalesce(F.expr(text), F.lit(False))


def plan(documents: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost on a bounded sample. Base rules stay among themselves in front
    only as far as the measure says; the verdict does not depend on the order."""
    sample = store.keep(with_metrics(documents.limit(sample_rows), text_col).select("_text", *METRICS), "quality-sample")
    shares = sample.agg(*(F.avg(_condition(r).cast("double")).alias(r.name) for r in rules)).first()
    if shares[0] is None:
        return list(rules)
    worth = {}
    for r in rules:
        began = time.perf_counter()
        sample.select(F.count_if(_condition(r))).collect()
        worth[r.name] = (shares[r.name] + 1e-6) / (time.perf_counter() - began)
    return sorted(rules, key=lambda r: -worth[r.name])


def judge(documents: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``row``, the metrics, base_failed, kept and rejected_by (the first rule, in cascade order, that rejects)."""
    measured = with_metrics(documents, text_col)
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        first = F.when(_condition(rule), F.lit(rule.name)).otherwise(first)
    base = F.lit(False)
    for rule in rules:
        if rule.base:
            base = base | _condition(rule)
    return measured.select("row", *METRICS, base.alias("base_failed"), first.alias("rejected_by")).withColumn("kept", F.col("rejected_by").isNull())


def op2(spark, sf_dir: str) -> DataFrame:
    documents = store.table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(documents, plan(documents))
    return judged.select(F.col("row.doc_id").alias("doc_id"), *METRICS, "base_failed", "kept")
