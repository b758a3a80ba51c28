"""URL rules against a plain loop over all rules."""

import random
import re

from pyspark.sql import functions as F

from hourglass.llm import urlrules

RULES = "host string, path string, verdict string"
URLS = "page_id long, url string"


def split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain(url, rules, default="allow"):
    host, path = split(url)
    best = None
    for (h, p), v in rules.items():
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h + p), len(h), h + p, v))
    return (host, path, best[2], best[3]) if best else (host, path, None, default)


def judged(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), URLS).repartition(5)
    out = urlrules.judge(df, spark.createDataFrame([(*k, v) for k, v in rules.items()], RULES)).collect()
    assert len(out) == len(urls)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}


def test_nested_rules_equal_a_loop(spark):
    r = random.Random(5)
    labels = ["a", "b", "aa", "com", "é", "x-y", ""]
    parts = ["/", "/a", "/a/", "/a/b", "/aé", "/b", "", "/a/b/c"]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randint(1, 4)))
    rules = {(host(), r.choice(parts)): r.choice(["allow", "block"]) for _ in range(120)}
    rules[("", "/a/b")] = "block"
    hot = "http://a.b.com/a/b/c"
    urls = [f"http{r.choice(['', 's'])}://{host()}{r.choice(parts)}{r.choice(['', '?q=/a', '#/b', 'z'])}" for _ in range(500)] + [hot] * 300
    got = judged(spark, urls, rules)
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_many_ranges_and_deep_nests(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")  # more ranges than keys between two rules
    try:
        rules = {("com", "/" + "a" * i): ("allow", "block")[i % 2] for i in range(24)}
        urls = [f"http://x{i % 3}.com/{'a' * (i % 30)}{'b' * (i % 2)}" for i in range(400)]
        assert judged(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_cases(spark):
    rules = {("com", "/"): "allow", ("example.com", "/en/"): "block", ("", ""): "block"}
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/EN/x", "http://example.com/en/\n?x", "a://b://c/d", "http://example.com:80/en/", "http://u@example.com/en/", "http://com", "http://ÉX.com/é", "http://example.com/en/" + "y" * 200_000, "http://example.com.//en/"]
    assert judged(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}
    assert judged(spark, urls, {("com", "/"): "allow"})[0] == ("", "", None, "allow")


def test_repeats_nulls_clashes_and_empty_tables(spark):
    rules = spark.createDataFrame([("A.com", "/", "allow"), ("a.com", "/", "block"), ("b.com", None, "block"), ("c.com", "/", None), (None, "/none", "block")], RULES)
    rows = [(1, "http://a.com/", 0)] * 3 + [(None, "http://b.com", 1), (None, "http://c.com/", 2), (2, "http://d/none", 3)]
    names = ["host", "path", "rule", "verdict", "_n", "_k", "_id", "_row", "_rc"]
    df = spark.createDataFrame(rows, "page_id long, url string, x int").select("page_id", "url", *[F.col("x").alias(n) for n in names])
    got = sorted(map(tuple, urlrules.judge(df, rules).collect()), key=str)
    assert got == sorted([(1, "a.com", "/", "a.com/", "block")] * 3 + [(None, "b.com", "", "b.com", "block"), (None, "c.com", "/", None, "allow"), (2, "d", "/none", "/none", "block")], key=str)
    assert urlrules.judge(df.limit(0), rules).count() == 0
    bare = urlrules.judge(df, rules.limit(0), default="block").collect()
    assert len(bare) == len(rows) and {(r.rule, r.verdict) for r in bare} == {(None, "block")}


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], URLS)
    rules = spark.createDataFrame([("com", "/", "allow")], RULES)
    plan = urlrules.judge(df, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
