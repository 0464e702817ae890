"""Secret scans with an incremental blob ledger, by built-in functions.

A blob is a text addressed by its SHA-256. The ledger is a table with one row per scanned pair of blob and rule
version: the pair and the findings in that blob. A scan takes any set of versions (path, text):

1. equal texts are merged to one blob (copies shrink to one row per task before the shuffle),
2. pairs of blob and rule version that the ledger has are taken away, so only unseen pairs are scanned,
3. their findings are appended to the ledger, pairs without findings included,
4. findings of all rules are joined back to every path that has, or ever had, the blob.

A rule changes its version when its pattern changes; only that rule's pairs are scanned again.

Defined results: a null text is the empty text. Repeated paths are separate versions and get the findings each time.
No versions give no rows and leave the ledger as it is. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from trustflow.llm import store
from trustflow.llm.patterns import find_all

FINDINGS = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of pattern of which the given group has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    base: bool = False
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The first three are given (runs below the least length of the last two cannot match at a later place of the same run
#: either, so the length stands in the pattern); the others are the method's own.
RULES = (
    Rule("assign", 1, ASSIGN, True, 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", True),
    Rule("hex", 1, r"[0-9a-f]{24,}", True),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]{1,20} ){0,3}PRIVATE KEY-----"),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("github", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
)


def findings(text: Column, rule: Rule) -> Column:
    found = find_all(text, rule.pattern)
    if rule.least:
        found = F.filter(found, lambda x: F.length(F.regexp_extract(x["match"], rule.pattern, rule.group)) >= rule.least)
    return F.transform(
        found,
        lambda x: F.struct(F.lit(rule.kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end")),
    ).cast(FINDINGS)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(blob, rule, found) of all scans so far; empty before the first."""
    schema = f"blob string, rule string, found {FINDINGS}"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def scan(versions: DataFrame, ledger_path: str, rules=RULES, text_col: str = "text") -> DataFrame:
    """Scans what is unseen, appends it to the ledger, and returns ``row`` (each version's row without its text),
    ``blob`` and ``found`` (all findings of these rules)."""
    spark = versions.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = F.struct(*(F.col(c) for c in versions.columns if c != text_col))
    paths = versions.select(rest.alias("row"), F.sha2(text, 256).alias("blob"))
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    keys = [r.key for r in rules]
    seen = (
        ledger(spark, ledger_path).filter(F.col("rule").isin(keys))
        .groupBy("blob").agg(F.collect_set("rule").alias("seen"))  # at most one entry per rule
    )
    blobs = blobs.dropDuplicates(["blob"]).join(seen, "blob", "left")
    todo = F.array_except(F.lit(keys), F.coalesce("seen", F.array().cast("array<string>")))
    blobs = blobs.withColumn("todo", todo).filter(F.size("todo") > 0)
    results = F.array(*(F.when(F.array_contains("todo", r.key), F.struct(F.lit(r.key).alias("rule"), findings(F.col("text"), r).alias("found"))) for r in rules))
    scanned = blobs.select("blob", F.inline(F.filter(results, lambda x: x.isNotNull())))
    scanned.write.mode("append").parquet(ledger_path)
    found = ledger(spark, ledger_path).filter(F.col("rule").isin(keys) & (F.size("found") > 0))
    # At most one entry per rule, even where a job has been run again.
    by_blob = found.groupBy("blob").agg(F.flatten(F.collect_set("found")).alias("found"))
    joined = paths.join(by_blob, "blob", "left")
    return joined.select("row", "blob", F.coalesce("found", F.array().cast(FINDINGS)).alias("found"))


def span_text(found: Column, kinds: list[str]) -> Column:
    """kind:start:end by start, then kind as listed."""
    order = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.array_position(F.lit(kinds), x["kind"]).alias("no"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.concat_ws(",", F.transform(F.sort_array(order), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def of_kind(found, kind: str) -> Column:
    return F.filter(found, lambda x: x["kind"] == kind)


def op7(spark, sf_dir: str) -> DataFrame:
    documents = store.table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds, base = [r.kind for r in RULES], [r.kind for r in RULES if r.base]
    found = scan(documents, store.new_path(spark, "ledger"))
    only = F.filter("found", lambda x: x["kind"].isin(base))
    counts = [F.size(of_kind("found", k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *counts,
        F.sha2(span_text(only, kinds), 256).alias("base_sha256"), span_text(F.col("found"), kinds).alias("spans"),
    )
