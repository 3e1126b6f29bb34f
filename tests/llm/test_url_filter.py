"""URL parts and rules against plain Python; reputation against its own formulas."""

import math

import pytest
from pyspark.sql import functions as F

from chamberlens.llm.url_filter import RULES, domain_of, filter_urls, host_of, host_reputation, path_of, suffix_of

URLS = [
    "https://A.Example.ORG/es/1?q#f",
    "http://example.org/en/17",
    "http://example.org/en/2",
    "http://sub.example.org/en/1",
    "ftp://xexample.org/es/",
    "https://shop.com/fr/x",
    "https://shop.com/de/x",
    "https://com/de/",
    "https://shop.com",
    "https://org?x=/",
    "no scheme.org/es/",
    "x://y://z/p",
    "://h#a/b",
    "",
    None,
    "https://ÄB.com/de/1",
    "http://notcom/de/1",
]


def plain(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = []
    for verdict, rule in RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def no_trials(spark):
    return spark.createDataFrame([], "host string, bad int")


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in filter_urls(pages, no_trials(spark)).collect():
        host, path, rule, verdict = plain(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), URLS[r["page_id"]]


def test_levels_of_a_host(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "com": ("com", "com"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", domain_of(F.col("h")), suffix_of(F.col("h")))
    assert {r[0]: (r[1], r[2]) for r in df.collect()} == hosts


def test_reputation_follows_the_evidence(spark):
    rows = [("bad.com", 1)] * 95 + [("bad.com", 0)] * 5 + [("good.com", 0)] * 100 + [("one.com", 1)] + [("new.com", None)] + [(None, 1)]
    rows += [(f"h{i}.net", i % 3 == 0 and 1 or 0) for i in range(60) for _ in range(5)]
    got = {r["host"]: r for r in host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert None not in got and got["bad.com"]["blocked"] and not got["good.com"]["blocked"] and not got["new.com"]["blocked"]
    assert got["good.com"]["mean"] < got["new.com"]["mean"] < got["one.com"]["mean"] < got["bad.com"]["mean"]
    assert got["bad.com"]["n_labelled"] == 100 and got["new.com"]["n_labelled"] == 0
    m = got["bad.com"]["mean"]
    assert got["bad.com"]["bound"] < m and math.isclose(m, 0.95, abs_tol=0.05)


def test_reputation_decides_where_no_rule_does(spark):
    trials = spark.createDataFrame([("bad.net", 1)] * 50 + [("ok.net", 0)] * 50, "host string, bad int")
    pages = spark.createDataFrame([(1, "http://bad.net/x"), (1, "http://bad.net/x"), (2, "http://ok.net/x"), (3, "http://unseen.net/")], "page_id long, url string")
    got = sorted((r["page_id"], r["verdict"]) for r in filter_urls(pages, trials).collect())
    assert got == [(1, "block"), (1, "block"), (2, "allow"), (3, "allow")]


@pytest.mark.parametrize("rows", [[], [("a.com", None)], [("a.com", 1)], [("a.com", 0), ("b.com", 0)]])
def test_little_or_no_evidence(spark, rows):
    got = host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()
    assert len(got) == len({h for h, _ in rows}) and not any(r["blocked"] is None for r in got)


def test_clashing_names_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    for name in ("host", "rule", "_host", "_judged", "domain", "suffix", "prior_s", "k", "n"):
        pages = pages.withColumn(name, F.lit("x"))
    got = filter_urls(pages, no_trials(spark)).first()
    assert (got["host"], got["rule"], got["_host"], got["domain"]) == ("a.org", "org/", "x", "x")
    assert filter_urls(pages.where("false"), no_trials(spark)).count() == 0
