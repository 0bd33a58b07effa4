from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import bloom, urls
from strata.llm.queries import URL_RULES

URLS = [
    None,
    "",
    "no scheme/en/",
    "http://A.Example.NET/en/1?x#y",
    "http://a.example.net/EN/1",
    "https://example.net",
    "https://example.net?/en/",
    "http://example.com/de/",
    "http://notexample.com/de/x",
    "http://www.example.org/fr/2#z",
    "x://org/fr/",
    "http://net/",
    "http://n.et/",
    "http://example.net:80/en/",
    "http:///path",
    "http://h/a?u=http://example.com/de/",
    "http://" + "s." * 30_000 + "net/" + "p/" * 3000,
    "http://www.spam.test/page.html?id=3",
    "http://spam.test/page/",
    "http://spam.test/page2",
]


def brute_force(url, pages):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    best = None
    for rule, verdict in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or (0, "", ""), (len(rule), rule, verdict))
    if best:
        return host, path, best[1], best[2]
    return host, path, None, "block" if url in pages else "allow"


def pages_table(spark, found=URLS):
    rows = [(k, u, None) for k, u in enumerate(found)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_equals_brute_force(spark):
    spam = spark.createDataFrame([("http://spam.test/page",)], "url string")
    listed = urls.rule_list(spark, URL_RULES).unionByName(urls.listed_pages(spam))
    pages = pages_table(spark).unionByName(pages_table(spark)).withColumn("rule", F.lit("clash")).withColumn("key", F.lit(1))
    out = urls.judge(pages, listed).collect()
    assert len(out) == 2 * len(URLS)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == brute_force(URLS[r.page_id], URLS[17:19]), r.url


def test_prefix_inside_a_segment_and_ties(spark):
    listed = urls.rule_list(spark, [("a.b/x", "allow"), ("b/x/y", "block"), ("b", "block")])
    pages = pages_table(spark, ["http://a.b/xy", "http://a.b/x/y", "http://b/", "http://q/"])
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, listed).collect()}
    assert got == {0: ("a.b/x", "allow"), 1: ("b/x/y", "block"), 2: ("b", "block"), 3: (None, "allow")}


def test_empty_list_and_empty_pages(spark):
    none = spark.createDataFrame([], urls.LIST_SCHEMA)
    assert {r.verdict for r in urls.judge(pages_table(spark), none).collect()} == {"allow"}
    assert urls.judge(pages_table(spark, []), urls.rule_list(spark, URL_RULES)).collect() == []


def test_bloom_filter_loses_no_member_and_stops_most_others(spark):
    members = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    bits, blocks = bloom.build(members, "key", 5000)
    probe = spark.range(20000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    passed = [r.id for r in bloom.possible(probe, "key", bits, blocks).collect()]
    assert set(range(5000)) <= set(passed)
    assert len(passed) < 5000 + 0.02 * 15000
    assert bits.count() <= blocks <= bloom.MAX_BLOCKS
    assert bloom.build(members, "key", 10**12)[1] == bloom.MAX_BLOCKS
