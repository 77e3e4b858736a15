"""URL rules: brute force over nested hosts and paths, odd rows, one url in very many rows."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from cohortlens.llm import urlrules

RULES = "host string, path string, verdict string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules, default="allow"):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = host.translate(LOWER)
    best = None
    for h, p, v in rules:
        h = h.translate(LOWER)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h) + len(p), len(h), h + p, v))
    return host, path, best and best[2], best[3] if best else default


def check(spark, urls, rules, **how):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, spark.createDataFrame(rules, RULES), **how).collect()}
    assert got == {i: brute(u, rules, **how) for i, u in enumerate(urls)}


def test_against_brute_force(spark):
    rng = random.Random(5)
    labels, steps = ["a", "b", "ab", "B", "com", "é"], ["/", "/a", "/a/", "/a/b", "", "/é", "/a/b/c", "//"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 5)))
    rules = list({(h.translate(LOWER), p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), rng.choice(steps)) for _ in range(300))}.values())
    urls = [f"{rng.choice(['http', 'ftp', ''])}://{host()}{rng.choice(steps)}{rng.choice(['', '?q=/a', '#a', 'x', 'b/c/d'])}" for _ in range(3000)]
    check(spark, urls, rules)
    check(spark, urls, rules, default="block")


def test_odd_urls(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("", "", "block")]
    urls = [None, "", "no scheme", "://", "http://", "http://COM", "http://com/", "http://xcom/", "http://x.com./", "http://a://b.com/", "http://com?/x", "http://com#/x",
            "http://www.Example.com/en/1", "http://example.com/EN/", "http://com:80/", "http://u@com/", "http://com/" + "x" * 300_000, "http://" + "a." * 20_000 + "com/y", "http://com/a\nb?c"]
    check(spark, urls, rules)


def test_equal_rules_and_ties(spark):
    rules = [("a.com", "/", "allow"), ("a.com", "/", "block"), ("com", "/xx/", "allow"), ("x.com", "/x", "block")]
    check(spark, ["http://a.com/", "http://x.com/xx/"], rules)
    got = urlrules.judge(spark.createDataFrame([("http://a.com/",)], "url string"), spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block"), ("com", "/", None)], RULES))
    assert [tuple(r) for r in got.collect()] == [("http://a.com/", "a.com", "/", "a.com/", "block")]


def test_one_url_in_many_rows_spreads(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "SEGMENT_ROWS", 500)
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("http://x.net/es/"), "id")).otherwise("http://x.net/es/1").alias("url"))
    rules = [("net", "/es/", "block"), ("x.net", "/es/1", "allow"), ("x.net", "/es/12", "block")]
    cuts = []
    real = urlrules._splitters
    monkeypatch.setattr(urlrules, "_splitters", lambda *a: cuts.extend(real(*a)) or cuts)
    got = urlrules.judge(pages, spark.createDataFrame(rules, RULES))
    assert got.count() == 20_000
    assert sum(key == b"net.x//es/1" for key, _ in cuts) > 20  # the hot key is cut into many segments
    bad = [r for r in got.collect() if (r.host, r.path, r.rule, r.verdict) != brute(r.url, rules)]
    assert bad == []


def test_extra_columns_and_empty_tables(spark):
    pages = spark.createDataFrame([("http://a.com/", "old", "old", 1, b"x", None), ("http://a.com/", "old", "old", 1, b"x", None)],
                                  "url string, host string, rule string, uid int, key binary, segment string")
    rules = spark.createDataFrame([("com", "/", "block")], RULES)
    got = urlrules.judge(pages, rules)
    assert got.columns == ["url", "uid", "key", "segment", "host", "path", "rule", "verdict"]
    assert [(r.uid, r.rule, r.verdict) for r in got.collect()] == [(1, "com/", "block")] * 2
    assert urlrules.judge(pages.limit(0), rules).count() == 0
    assert [r.verdict for r in urlrules.judge(pages, rules.limit(0), carry=[]).collect()] == ["allow"] * 2
