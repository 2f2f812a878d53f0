import random
import re

import pytest

from tideline.llm import url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def judge(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    "http://a.example.net/en/1?x#y", "https://EXAMPLE.net/en", "http://net/", "http://net", "http://x.NET?/en/", "https://b.example.com/de/x",
    "https://example.com/de", "http://example.org/fr/", "ftp://org/fr/1", "no scheme", "", None, "://", "http:///en/", "http://xexample.net/en/",
    "http://a.b.c.example.net/en/z", "http://example.net/en/://net/", "http://user@example.net/en/", "http://example.net:80/en/", "http://ü.net/é",
    "http://h.net/" + "p" * 5000, "x://" + "a." * 300 + "net/",
]


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "kept", "replaced") for i, u in enumerate(urls)], "page_id long, url string, extra string, rule string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = url_filter.judge(pages, listed)
    assert out.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect())
    assert got == [(i, *judge(u, rules)) for i, u in enumerate(urls)]


def test_rules_of_the_query(spark):
    check(spark, URLS * 3, RULES)


def test_many_rules(spark):
    draw = random.Random(8)
    hosts = [".".join(draw.choices("abcd", k=draw.randrange(1, 4))) for _ in range(60)]
    paths = ["", "/", "/x", "/x/", "/y/z", "/long/path/"]
    rules = list({(h, p): (h, p, draw.choice(["allow", "block"])) for h, p in zip(draw.choices(hosts, k=150), draw.choices(paths, k=150))}.values())
    urls = [f"http://{draw.choice(hosts)}{draw.choice(['', '/', '/x', '/xy', '/x/q', '/y/z1', '/long/path/1', '?q'])}" for _ in range(400)]
    check(spark, urls, rules)


@pytest.mark.parametrize("rules", [[], [(None, None, "block"), ("net", "/", None)]])
def test_empty_and_null_rules(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id long, url string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((r["page_id"], r["rule"]) for r in url_filter.judge(pages, listed).collect())
    assert [i for i, _ in got] == [1, 2]
    assert got[0][1] is None


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect() == []


def test_filter_finds_every_listed_key(spark):
    keys = spark.range(3000).selectExpr("concat('h', id, '.net/', id) AS rule_key")
    words = url_filter.build_filter(keys, 64)
    test = url_filter.tester(spark, words)
    hits = keys.selectExpr("array(xxhash64(rule_key)) AS h", "array(xxhash64(rule_key, 'bits')) AS s").select(test("h", "s").alias("t"))
    assert all(r["t"] == [True] for r in hits.collect())
