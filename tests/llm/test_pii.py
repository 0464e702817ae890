"""Personal data: the given kinds against a brute-force version, learned identifiers on a small corpus, and masking."""

import hashlib
import random
import re

from trustflow.llm import pii, store

ALL = re.ASCII
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or "", ALL):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def noisy(rng):
    parts = ["a@b.c", "x@y.z_q@w.e", "@", ".", "1.2.3.4", "0001.255.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "+1 (659) 555-3949",
             "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "4000 0000 0000 0000 006", "+", "123", " ", "-", "é", "😀",
             "user.name+tag@example-site.org", "12 34", "..", "+49 30 1234567", "99999999999999999999"]
    return "".join(rng.choice(parts) + rng.choice(["", " ", "", "-"]) for _ in range(rng.randint(0, 14)))


def test_given_kinds_on_noise(spark):
    rng = random.Random(8)
    texts = [noisy(rng) for _ in range(600)] + [None, "", "1" * 30_000, "a" * 50_000 + "@", "x@" + "a." * 5000, "+1" + " " * 20_000, "1.2.3" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: [tuple(s) for s in r.spans] for r in pii.marked(df).collect()}
    for i, text in enumerate(texts):
        assert sorted(got[i]) == sorted(plain_spans(text)), text[:200]


def test_registered_query_on_the_table(spark, sf_dir):
    got = {r.doc_id: r for r in pii.op8(spark, sf_dir).collect()}
    for r in store.table(spark, sf_dir, "documents").collect():
        spans = plain_spans(r.text)
        for kind in PATTERNS:
            assert got[r.doc_id][f"n_{kind}"] == sum(s[0] == kind for s in spans)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[r.doc_id].spans.startswith(text)


def corpus():
    rows = [(i, f"note {i} phone +1 212 555 {1000 + i} ext today") for i in range(12)]
    rows += [(100 + i, f"note phone 212-555-{2000 + i} ext today") for i in range(2)]
    rows += [(200 + i, f"order number {30000 + i} shipped") for i in range(9)]
    rows += [(300, "see phone book 98765-x"), (301, None), (302, ""), (100, "note phone 212-555-2000 ext today")]
    return rows


def test_learned_identifiers(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    got = [(r.row.doc_id, tuple(s)) for r in pii.extract(df).collect() for s in r.spans if s.kind.startswith("like_")]
    assert sorted(got) == [(100, ("like_phone", 11, 23)), (100, ("like_phone", 11, 23)), (101, ("like_phone", 11, 23))]


def test_a_chain_of_contexts_is_followed_to_its_end(spark):
    """Each context is supported by numbers learned from the one before it alone: four rounds learn something."""
    rows = [f"before-a +1 212 555 {1000 + i} after-a" for i in range(400)]
    chain = [(step, f"77-{step}{i:03d}-5555") for step, n in enumerate((120, 36, 10, 2)) for i in range(n)]
    for step, number in chain:
        rows += [f"before-{x} {number} after-{x}" for x in "abcde"[step : step + 2]]
    rows += [f"other{i} 88-{i}00-5555 word{i}" for i in range(9)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.instance: r.kind for r in pii.learned(pii.graph(pii.marked(df))).collect()}
    assert found == {number: "phone" for _, number in chain}


def test_mask_keeps_documents_columns_and_counts(spark):
    rows = [(i, t, "x", None if t is None else len(t), "s") for i, t in corpus()]
    rows += [(None, "é a@b.c 4111 1111 1111 1111!", "y", 3, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long, row string")
    out = pii.mask(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[3].text == "note 3 phone [PHONE] ext today"
    assert by[101].text == "note phone [PHONE] ext today"
    assert by[200].text == "order number 30000 shipped"
    assert by[None].text == "é [EMAIL] [CARD]!"
    assert all(r.text is None or r.n_chars == len(r.text) for r in got)
    assert by[301].text is None and by[302].text == ""


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert pii.extract(df).count() == 0
    assert pii.mask(df).count() == 0
