"""URL rules against a brute-force version, features, and the defined cases."""

import math
import re
from collections import Counter

from trustflow.llm import store, urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain(url):
    head, mark, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest)[0] if mark else ""
    path = re.match(r"[^?#]*", rest[len(host) :])[0] if mark else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


CASES = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/es/x", "http://example.org", "http://example.org?x=/es/", "http://a.example.org/en/12#f",
    "http://xorg/en/1", "http://org/", "https://É.example.COM/fr/?q=://b.org/", "http://b.com/de/", "http://b.com/DE/", "x://example.org/en/1",
    "http://myexample.org/es/", "http://a.b/c?d#e/f", "http://a.com:80/fr/a\nb", "http://example.org/en/1" + "9" * 50_000,
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "page_id long, url string")
    got = {r.row.page_id: r for r in urls.judge(df).collect()}
    for i, url in enumerate(CASES):
        host, path, rule, verdict = plain(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def test_registered_query(spark, sf_dir):
    got = {r.page_id: r for r in urls.op3(spark, sf_dir).collect()}
    for r in store.table(spark, sf_dir, "pages").select("page_id", "url").collect():
        host, path, rule, verdict = plain(r.url)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule)
        assert g.verdict == (verdict or g.verdict)


def test_entropy(spark):
    texts = ["", "aaaa", "abab", "http://x.y/ab12?é=😀\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", urls.entropy(urls.F.col("t")).alias("e"))
    for r in df.collect():
        n = len(r.t)
        assert math.isclose(r.e, -sum(c / n * math.log2(c / n) for c in Counter(r.t).values()), abs_tol=1e-9)


def test_method_learns_from_labelled_urls(spark):
    rows = [(i, f"http://h{i}.com/{'de' if i % 2 else 'fr'}/{'9' * 30 if i % 2 else 'story'}") for i in range(120)]
    rows += [(1000, "http://new.com/xx/" + "9" * 30), (1001, "http://new.com/xx/story")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string")
    got = {r.row.page_id: r.verdict for r in urls.judge(df).filter("by = 'method'").collect()}
    assert got == {1000: "block", 1001: "allow"}


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
