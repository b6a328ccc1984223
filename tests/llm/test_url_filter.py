import re

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm.url_filter import RULES, bad_urls, blocked_bloom, canonical, filter_urls, listed

URLS = [
    None, "", "no scheme/en/", "http://", "https://a.com", "https://a.com/", "HTTP://WWW.Example.COM/en/x?utm_source=f#t",
    "http://example.com/en/1", "http://m.example.com/en/", "http://example.com/fr/1", "http://b.net/es/2?x=1", "http://net/fr/",
    "http://b.net/en/2.html", "https://www.b.net/en/2/#top", "http://b.net/en/2?ref=z", "http://b.net/en/2?b=2&a=1",
    "http://b.net/en/2?a=1&b=2&utm_medium=q", "http://casino-win.b.org/x", "ftp://m.casino-win.b.org/x/index.html",
    "http://xcom/en", "http://b.org/" + "p" * 50_000, "x://y://z/w", "http://b.net/en/2\n",
]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        name, rest = rule.split("/", 1)
        fits = (host == name or host.endswith("." + name)) and path.startswith("/" + rest)
        if fits and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best


def pages(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(6, URLS[6]), (None, "http://b.net/en/2")]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(3)
    return df.withColumns({c: F.lit("x") for c in ("host", "key", "rule", "block", "possible", "is_listed", "found")})


def test_rules_and_list(spark):
    bad = spark.createDataFrame([("http://b.net/en/2",), (None,), ("",), ("http://www.b.net/en/2.html",)], "url string")
    got = filter_urls(pages(spark), bad, RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, best = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, best[1] if best else None)
        in_list = r.url in (URLS[12], URLS[13], URLS[14], "http://b.net/en/2")
        assert r.is_listed == in_list
        assert r.verdict == (best[0] if best else "block" if in_list else "allow")


def test_bad_hosts_are_blocked(spark):
    df = pages(spark)
    got = {r.url: r.verdict for r in filter_urls(df, bad_urls(df), RULES).collect()}
    assert got["http://casino-win.b.org/x"] == got["ftp://m.casino-win.b.org/x/index.html"] == "block"
    assert got["http://xcom/en"] == "allow"


@pytest.mark.parametrize("bits, most", [(16, 1 << 20), (16, 0), (1, 1 << 20)])
def test_filter_is_exact_whatever_its_size(spark, bits, most):
    keys = spark.range(500).select(F.concat(F.lit("k"), F.col("id") * 3).alias("key"))
    urls = spark.range(3000).select("id", F.concat(F.lit("k"), "id").alias("key")).union(
        spark.createDataFrame([(-1, None)], "id long, key string")
    )
    got = {r.id: r.is_listed for r in listed(urls, keys, bits, most).collect()}
    assert len(got) == 3001
    assert {i for i, v in got.items() if v} == set(range(0, 1500, 3))


def test_bloom_has_all_keys_in_bounded_blocks(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    assert blocked_bloom(keys, 63).count() <= 63


def test_canonical_spellings(spark):
    same = ["http://www.b.net/en/2.html#x", "https://m.b.net:443/en/2/", "http://B.NET/en/2/index.html?ref=1"]
    df = spark.createDataFrame([(u,) for u in same], "url string")
    assert {r.k for r in df.select(canonical(F.col("url")).alias("k")).collect()} == {"b.net/en/2"}


def test_empty(spark):
    df = pages(spark).filter("page_id < 0")
    assert filter_urls(df, bad_urls(df), RULES).count() == 0
    assert filter_urls(pages(spark), df, RULES).filter("is_listed").count() == 0


def test_every_bad_label_lists_its_urls(spark):
    hosts = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm", "garden"]
    rows = [(i, f"https://{h}.example.org/en/{i}") for i, h in enumerate(hosts)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.verdict for r in filter_urls(df, bad_urls(df), RULES).collect()}
    assert got == {i: "allow" if h == "garden" else "block" for i, h in enumerate(hosts)}
