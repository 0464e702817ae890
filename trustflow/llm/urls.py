"""URL filters: given host and path rules, and boosted trees on lexical features for the rest. Built-in functions and
Spark's own tree learner only.

A rule names a host with all its subdomains and the start of a path; of the rules that fit, the longest decides.
URLs that a rule decides are the labelled URLs. Suffix statistics (how many URLs a host suffix has, and the
share of its labelled URLs that are blocked) are counted over all rows. The trees are fitted on at most ``TRAIN_ROWS``
labelled URLs, those with the least hashes, and give the verdict where no rule fits.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no rule and is judged by its features
(those of the empty string for null). Repeated rows are judged each. Without labelled URLs of both verdicts
the method allows. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from trustflow.llm import store
from trustflow.llm.patterns import let

TRAIN_ROWS = 10_000
TREES = 12
DEPTH = 4
SEED = 3


@dataclass(frozen=True)
class Rule:
    """text: host and start of path in one, as in ``example.org/es/``."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

FEATURES = (
    "length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "letter_ratio", "hyphens",
    "parameters", "entropy", "fragment", "extension", "secure", "suffix_urls", "suffix_blocked",
)


def parsed(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``row``, url (null as empty), host and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(F.struct("*").alias("row"), url.alias("url"))
    at = F.instr("url", "://")
    rows = rows.withColumn("after", F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise(""))
    rows = rows.withColumn("name", F.regexp_extract("after", "^[^/?#]*", 0))
    path = F.regexp_extract(F.substring(F.col("after"), F.length("name") + 1, F.length("after")), "^[^?#]*", 0)
    host = F.translate("name", string.ascii_uppercase, string.ascii_lowercase)
    return rows.select("row", "url", host.alias("host"), path.alias("path"))


def ruled(rows: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule and rule_verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # the longest is asked first
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def entropy(text: Column) -> Column:
    """Bits per character: equal characters are runs once the characters are sorted."""
    letters = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(letters, F.lit(r"(?s)(.)\1*+"), F.lit(0))
    n = F.length(text).cast("double")
    bits = F.aggregate(
        F.transform(runs, lambda r: F.length(r) / n), F.lit(0.0), lambda a, p: a - p * F.log2(p)
    )
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def suffixes(rows: DataFrame) -> DataFrame:
    """(suffix, suffix_urls, suffix_blocked) over all rows; the share is drawn towards that of all labelled URLs."""
    counted = store.keep(
        rows.groupBy(suffix_of(F.col("host")).alias("suffix")).agg(
            F.count("*").alias("n"), F.count_if(F.col("rule_verdict") == "block").alias("blocked"), F.count("rule_verdict").alias("known")
        ),
        "suffix-counts",
    )
    whole = counted.agg(F.sum("blocked").alias("blocked"), F.sum("known").alias("known")).first()
    share = (whole.blocked or 0) / (whole.known or 1)
    return counted.select(
        "suffix", F.log1p("n").alias("suffix_urls"), ((F.col("blocked") + share) / (F.col("known") + 1)).alias("suffix_blocked")
    )


def with_features(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Adds ``x``, the features in order."""
    url, path = F.col("url"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)

    def count(text: Column, letters: str) -> Column:
        return F.length(text) - F.length(F.translate(text, letters, ""))

    n = F.greatest(F.length(url), F.lit(1))
    values = {
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length(path), "query_length": F.length(query),
        "depth": count(path, "/"), "labels": count(F.col("host"), "."), "digit_ratio": count(url, string.digits) / n,
        "letter_ratio": count(url, string.ascii_letters) / n, "hyphens": count(url, "-_"),
        "parameters": F.when(query == "", 0).otherwise(1 + count(query, "&;")), "entropy": let(url, entropy),
        "fragment": count(url, "#"), "extension": F.length(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)),
        "secure": url.startswith("https:").cast("int"), "suffix_urls": F.col("suffix_urls"), "suffix_blocked": F.col("suffix_blocked"),
    }
    joined = rows.withColumn("suffix", suffix_of(F.col("host"))).join(stats, "suffix")
    return joined.withColumn("x", array_to_vector(F.array(*(values[f].cast("double") for f in FEATURES)))).drop("suffix", *stats.columns)


def fit(rows: DataFrame, stats: DataFrame, train_rows: int = TRAIN_ROWS):
    """The model, or None where there are no two verdicts to learn from."""
    labelled = rows.filter(F.col("rule_verdict").isNotNull()).select("url", "host", "path", "rule_verdict")
    sample = store.keep(labelled.orderBy(F.xxhash64("url"), "url").limit(train_rows), "labelled-urls")
    if sample.select("rule_verdict").distinct().count() < 2:
        return None
    train = with_features(sample, stats).withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    return GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(train.select("x", "label"))


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``row``, host, path, rule, verdict and by (rule or method)."""
    rows = ruled(parsed(pages, url_col), rules)
    stats = store.keep(suffixes(rows), "suffixes")
    model = fit(rows, stats, train_rows)
    if model is None:
        scored = rows.withColumn("prediction", F.lit(0.0))
    else:
        scored = model.transform(with_features(rows, stats))
    own = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    return scored.select(
        "row", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").otherwise("method").alias("by"),
    )


def op3(spark, sf_dir: str) -> DataFrame:
    judged = judge(store.table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")
