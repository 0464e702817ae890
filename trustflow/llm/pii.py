"""Personal data: given patterns as seeds, and identifiers learned from their contexts. Built-in functions only.

1. Seeds. E-mail and IP addresses, card and phone numbers by pattern and check (parts, Luhn, digits).
2. Candidates. Every run of letters, digits and ``@._%+-`` with four digits or an ``@`` that no seed overlaps might be an
   identifier; it is an instance of unknown kind, as each seed is one of its kind.
3. Patterns. The word before, the word after, and both together are the lexical patterns of a candidate. The graph of
   patterns and instances is built over all documents, each pair once however often it occurs.
4. Rounds. A pattern's confidence in a kind is the score of its instances of that kind over the number of its
   instances plus one; patterns need ``SUPPORT`` scored instances and ``CONFIDENCE``. An unknown
   instance scores 1 - product(1 - confidence) over its patterns; with two patterns and
   ``ACCEPT`` it is learned, stays learned with that kind and score, and supports patterns in the next round. Rounds go on
   until one learns nothing new; each other one adds an instance, so they end.
5. Learned instances are joined back to every place where they stand, as kind ``like_<kind>``. Seeds always stay.

Counts before scores combine before each shuffle; a hot context or a hot instance is one row of the graph per partner,
and its joins are ordinary ones that can be split. Texts are read once and do not move.

Defined results: null and empty texts have no spans. Repeated rows are each reported. Spans count code points, the
end is exclusive. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trustflow.llm import store
from trustflow.llm.patterns import find_all, let

#: The given patterns, with guards that only skip starts that cannot be the leftmost.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CANDIDATE = r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z._%+-]*+[0-9@])[A-Za-z0-9@._%+-]{6,}+"

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int>>"
SUPPORT = 5
CONFIDENCE = 0.75
ACCEPT = 0.97


def luhn(digits: Column) -> Column:
    def value(d: Column, i: Column) -> Column:
        n = d.cast("int") * (1 + i % 2)
        return F.when(n > 9, n - 9).otherwise(n)

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), value)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _small(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+(?=.)", "")
    return (F.length(bare) <= 3) & (F.substring(bare, 1, 3).try_cast("int") <= 255)


def holds(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _small)
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(F.translate(match, " ().-+", "")).between(8, 15)
    return F.lit(True)


def _described(kind: str | None):
    """A match as an instance with its kind (null for unknown), place, and the words beside it."""
    return lambda x: F.struct(
        F.lower(x["match"]).alias("instance"), F.lit(kind).cast("string").alias("kind"),
        x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"),
        F.lower(F.regexp_extract(x["before"], r"([^\x20\x09-\x0D]{1,40}+)[\x20\x09-\x0D]*+$", 1)).alias("left"),
        F.lower(F.regexp_extract(x["after"], r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]{1,40}+)", 1)).alias("right"),
    )


def _keeps(kind: str):
    return lambda x: holds(kind, x["match"])


def seeds(text: Column) -> Column:
    """Instances of the four kinds."""
    found = []
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True):
        kept = find_all(text, pattern)
        if kind != "email":
            kept = F.filter(kept, _keeps(kind))
        found.append(F.transform(kept, _described(kind)))
    return F.concat(*found)


def unknown(text: Column, known: Column) -> Column:
    """Candidates that no seed overlaps."""
    likely = F.filter(
        find_all(text, CANDIDATE),
        lambda x: x["match"].contains("@") | (F.length(F.regexp_replace(x["match"], "[^0-9]", "")) >= 4),
    )
    placed = F.transform(likely, _described(None))
    return F.filter(placed, lambda c: ~F.exists(known, lambda s: (s["start"] < c["end"]) & (s["end"] > c["start"])))


def marked(documents: DataFrame, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Stored: rid, ``row`` (without the text unless asked for), spans and candidates."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = [F.col(c) for c in documents.columns if with_text or c != text_col]
    rows = documents.select(F.struct(*rest).alias("row"), text.alias("_text"))
    spans = F.transform("_seeds", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(SPANS)
    rows = rows.select("row", let(seeds(F.col("_text")), lambda s: F.struct(s.alias("s"), unknown(F.col("_text"), s).alias("u"))).alias("_f"))
    rows = rows.select("row", F.col("_f.s").alias("_seeds"), F.concat("_f.s", "_f.u").alias("candidates"))
    return store.keep(rows.select(F.monotonically_increasing_id().alias("rid"), "row", spans.alias("spans"), "candidates"), "pii-marked")


def graph(found: DataFrame) -> DataFrame:
    """(pattern, instance, kind): each pair once; kind is null for unknown instances."""
    c = found.select(F.inline("candidates")).select("instance", "kind", "left", "right")
    pattern = F.explode(
        F.filter(
            F.array(
                F.when(F.col("left") != "", F.concat(F.lit("L "), "left")),
                F.when(F.col("right") != "", F.concat(F.lit("R "), "right")),
                F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("B "), "left", F.lit(" "), "right")),
            ),
            lambda p: p.isNotNull(),
        )
    )
    return c.select(pattern.alias("pattern"), "instance", "kind").groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))


def learned(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, accept: float = ACCEPT) -> DataFrame:
    """(instance, kind) of the unknown instances that the patterns give away."""
    spark = edges.sparkSession
    edges = store.keep(edges, "pii-graph")
    # Patterns without a seed can only come in through learned instances; those without any support are left out of the rounds.
    known = spark.createDataFrame([], "instance string, kind string, score double")
    while True:
        k = known.select("instance", F.col("kind").alias("like"), "score")
        scored = edges.join(k, "instance", "left").select(
            "pattern", "instance", F.coalesce("kind", "like").alias("kind"), F.when(F.col("kind").isNotNull(), 1.0).otherwise(F.col("score")).alias("score")
        )
        sums = scored.groupBy("pattern", "kind").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
        # A pattern has at most one row per kind and one for unknown instances.
        whole = sums.groupBy("pattern").agg(F.sum("n").alias("all"), F.max(F.when(F.col("kind").isNotNull(), F.struct("score", "kind", "n"))).alias("best"))
        good = whole.select("pattern", F.col("best.kind").alias("kind"), (F.col("best.score") / (F.col("all") + 1)).alias("confidence"), F.col("best.n").alias("n"))
        good = store.keep(good.filter((F.col("n") >= support) & (F.col("confidence") >= confidence)), "pii-patterns")
        votes = edges.filter("kind IS NULL").select("pattern", "instance").join(good, "pattern").groupBy("instance", "kind").agg(
            F.count("*").alias("patterns"), (1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score")
        )
        best = votes.filter((F.col("patterns") >= 2) & (F.col("score") >= accept)).groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b"))
        now = best.select("instance", F.col("b.kind").alias("kind"), F.col("b.score").alias("score"))
        new = store.keep(now.join(known.select("instance"), "instance", "left_anti"), "pii-learned")
        if new.isEmpty():
            break
        # What was learned before stays as it was, so a round depends on the instances learned so far and nothing else.
        known = store.keep(known.union(new), "pii-known")
    return known.select("instance", "kind")


def with_learned(found: DataFrame, **options) -> DataFrame:
    """found, with the spans of learned instances added to ``spans``."""
    names = learned(graph(found), **options)
    places = found.select("rid", F.inline("candidates")).filter("kind IS NULL").select("rid", "instance", "start", "end")
    # Entries of one document; never more than it has candidates.
    more = (
        places.join(names, "instance").groupBy("rid")
        .agg(F.collect_list(F.struct(F.concat(F.lit("like_"), "kind").alias("kind"), "start", "end")).alias("more"))
    )
    out = found.join(store.keep(more, "pii-more"), "rid", "left")
    return out.select("row", F.concat("spans", F.coalesce("more", F.array().cast(SPANS))).cast(SPANS).alias("spans"))


def extract(documents: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``row`` (each row without its text) and ``spans``."""
    return with_learned(marked(documents, text_col), **options)


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans count as the first of them."""
    order = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        name = F.concat(F.lit("["), F.upper(F.regexp_replace(s["kind"], "^like_", "")), F.lit("]"))
        out = F.when(s["start"] >= a["at"], F.concat(a["out"], gap, name)).otherwise(a["out"])
        return F.struct(out.alias("out"), F.greatest(a["at"], -s["minus_end"]).alias("at"))

    whole = F.aggregate(
        order, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def mask(documents: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """All documents with their own columns; personal data masked, the character count kept true."""
    found = with_learned(marked(documents, text_col, with_text=True), **options)
    text = masked(F.col(f"row.{text_col}"), F.col("spans"))
    out = found.select("row", text.alias("clean")).select(
        *(
            F.col("clean").alias(c) if c == text_col else F.length("clean").cast("long").alias(c) if c == chars_col else F.col(f"row.`{c}`").alias(c)
            for c in documents.columns
        )
    )
    return out


def span_text(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start."""
    kinds = [*KINDS, *(f"like_{k}" for k in KINDS)]
    order = F.transform(spans, lambda s: F.struct(F.array_position(F.lit(kinds), s["kind"]).alias("no"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.concat_ws(",", F.transform(F.sort_array(order), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def op8(spark, sf_dir: str) -> DataFrame:
    found = extract(store.table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(list(KINDS)))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *(F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )
