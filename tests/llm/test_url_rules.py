import re

import pytest

from tidewell.llm.url_rules import judge_urls
from tidewell.operators.sizing import Bound

SCHEMA = "page_id long, url string"
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("Shop.Example.com", "/de/sale", "allow"), ("shop.example.com", "/de/sale", "block"), ("plain.org", "", "block"), ("plain.org", None, "allow"),
    ("a.b.c.d.e", "/x/y/z/", "block"), ("e", "/x/y/z/long/", "allow"), (None, "/", "block"), ("", "/", "block"), ("com", "de/", "block"),
    ("never.com", "/?", "block"), ("com", "/novote/", None),
]
URLS = [
    "http://x.net", "http://x.net/", "http://NET/a", "http://www.Example.NET/en/1?x=/fr/", "http://example.net/EN/", "http://example.net/en",
    "https://example.com/de/1", "https://shop.example.com/de/sales/1", "https://notexample.com/de/1", "http://a.org/fr/#x", "http://org/fr/",
    "http://plain.org?x", "http://plain.org#/fr/", "x.net/en/", "", None, "://net/", "a://b://net/", "http://a.b.c.d.e/x/y/z/q", "http://a.b.c.d.e/x/y/z/long/q",
    "http://.net/", "http://x.net./", "http://user@x.net:80/", "http://x.net:80/", "http:///x/", "http://é.NET/ü?", "http://x\n.net/\n/", "http://com/de/", "http://a.com/novote/",
    "http://" + "a." * 3000 + "net/" + "b/" * 3000,
]


def brute(pages, rules):
    out = []
    for page_id, url, *_ in pages:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest).group()
            path = re.match("[^?#]*", rest[len(host):]).group()
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        best = None
        for rule_host, rule_path, verdict in rules:
            rule_host, rule_path = (rule_host or "").lower(), rule_path or ""
            if rule_host and verdict and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
                best = max(best or (0,), (len(rule_host + rule_path), len(rule_host), verdict == "block", rule_host + rule_path))
        out.append((page_id, host, path, best and best[3], "block" if best and best[2] else "allow"))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


@pytest.mark.parametrize("bound", [Bound(), Bound(max_rows=0)], ids=["broadcast", "salted"])
def test_rules_against_brute_force(spark, bound):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (3, URLS[3]), (None, None), (None, None), (None, URLS[6]), (4, URLS[0])]
    df = spark.createDataFrame(pages, SCHEMA).selectExpr("*", *[f"'x' AS {n}" for n in ("key", "code", "prefix", "digest", "candidates", "copies", "html")])
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert found(judge_urls(df, rules, bound=bound)) == brute(pages, RULES)


def test_empty_tables(spark):
    none, rules = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "host string, path string, verdict string")
    assert judge_urls(none, rules).count() == 0
    one = spark.createDataFrame([(1, "http://x.net/")], SCHEMA)
    assert found(judge_urls(one, rules)) == [(1, "x.net", "/", None, "allow")]


def test_plan_stays_native_and_keeps_pages_in_one_shuffle(spark):
    rules = spark.sql("SELECT * FROM VALUES ('net', '/', 'block'), ('org', '/', 'block') AS rules(host, path, verdict)")
    df = judge_urls(spark.createDataFrame([(1, "http://x.net/")], SCHEMA), rules)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
