"""URL rules and the n-gram model."""

import re

import pytest
from pyspark.sql import functions as F

from glyphmill.llm import urls
from glyphmill.llm.queries import URL_RULES, url_labels

URLS = [
    None,
    "",
    "no scheme/here",
    "http://Example.ORG/en/15?q=/es/",
    "https://a.example.org/es/1#x",
    "https://example.org",
    "https://example.org/",
    "http://x.com/fr/",
    "http://x.com/fr",
    "http://x.com/de/1",
    "http://xcom/de/1",
    "http://org/abc",
    "http://a.b?x=://c/d",
    "://h/p",
    "http://É.org/ü",
    "http://a.net/" + "p" * 50_000,
]


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.DOTALL)
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = []
    for rule, verdict in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


@pytest.fixture(scope="module")
def model(spark):
    return urls.fit_urls(url_labels(spark))


def test_rules_equal_brute_force(spark, model):
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    found = rows.select("url", urls.judge_url(F.col("url"), urls.Rules(URL_RULES), model).alias("j")).collect()
    for row in found:
        host, path, rule, verdict = brute(row["url"])
        assert (row["j"]["host"], row["j"]["path"], row["j"]["rule"]) == (host, path, rule)
        assert row["j"]["verdict"] == (verdict or row["j"]["verdict"]) and row["j"]["verdict"] in ("allow", "block")
    assert rows.limit(0).select(urls.judge_url(F.col("url"), urls.Rules([]), model)).count() == 0


def test_names_are_recognised_elsewhere(model):
    for name, blocked in (("casino-win", True), ("cheap-pills", True), ("library", False), ("ththble", False)):
        for host in (f"{name}.example.info", f"shop.{name}.example.com"):
            assert (model.block_probability(host, "/it/77") >= 0.5) == blocked


def test_rule_ties_and_bounds():
    rules = urls.Rules([("a.b/x", "allow"), ("a.b/x", "block"), ("b/", "allow")])
    assert rules.find("a.b", "/xy") == ("a.b/x", "block") and rules.find("c.a.b", "/q") == ("b/", "allow")
    with pytest.raises(ValueError):
        urls.Rules([("a/", "maybe")])


def test_labels_of_one_class_or_none(spark):
    schema = "url string, blocked int"
    assert urls.fit_urls(spark.createDataFrame([], schema)).block_probability("a", "") < 0.01
    only = spark.createDataFrame([("http://a/", 1), (None, 1), ("http://b/", None)], schema)
    assert urls.fit_urls(only).block_probability("a", "") > 0.99


def test_names_outside_the_table_are_judged(spark, model):
    known = {urls.split_url(r["url"])[0].split(".example.")[0].split(".")[-1] for r in url_labels(spark).collect()}
    blocked = ["casino-win", "spam-farm", "adult-x", "ads-track", "free-bets", "cheap-pills", "royal-casino", "pillstore24",
               "mega-jackpots", "hot-escorts", "click-tracker", "lucky-slots"]
    ordinary = ["garden-house", "river-bank", "tionble", "ththin", "thering", "therre", "ththon", "old-library", "musicschool",
                "fresh-bread", "city-news", "green-kitchen"]
    assert not known & {*blocked, *ordinary}
    for names, wanted in ((blocked, True), (ordinary, False)):
        for name in names:
            for url in (("%s.example.org", "/en/1234"), ("m.%s.example.net", "/de/77.html")):
                assert (model.block_probability(url[0] % name, url[1]) >= 0.5) == wanted, name
