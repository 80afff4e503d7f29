from __future__ import annotations

import math
from collections import Counter

import pytest
from compare import connect, duck_rows, spark_rows
from conftest import plain
from pyspark.sql import functions as F

from cotag.llm import reputation as rp
from cotag.llm.oracles import ORACLES
from cotag.llm.queries import QUERIES


def test_query_equals_statement(spark, sf_dir):
    con = connect(sf_dir)
    assert spark_rows(QUERIES["op9_url_filter"](spark, sf_dir)) == duck_rows(con, ORACLES["op9_url_filter"])


def parts_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:end], rest[end:]
    cut = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:cut]


def rule_by_hand(host, path):
    fits = []
    for rule, verdict in rp.RULES:
        name, start = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.COM/en/1?x=/y#z", "http://www.example.com/en/",
    "http://www.example.com/en", "http://www.example.com", "http://x.www.example.com/en/a", "http://com/",
    "http://notcom/x", "http://example.net/es/1", "http://net/fr/", "http://net/de/", "a://b://c/d",
    "http://h.example.org?x#y/z", "http://h.example.org#a?b", "ftp://user@Host:80/p/../q", "http://ÄÖ.com/x",
    "http://example.com/en/\nx?y", "http://wwwexample.com/en/x", "http://..com/en/",
]


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(
        [(i, int(i % 4 != 0), 0) for i in range(60)] + [(1, 0, 0), (2, None, None), (None, 1, 0)],
        "doc_id long, quality int, toxic int",
    )


def test_urls_by_hand(spark, labels):
    pages = spark.createDataFrame(
        [(i, u, "<p>", "clash", "clash") for i, u in enumerate(URLS)],
        "page_id long, url string, html string, host string, verdict string",
    )
    got = {r["page_id"]: r for r in rp.judge_urls(pages, labels).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts_by_hand(url)
        rule, verdict = rule_by_hand(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] == verdict or rule is None


def reputation_by_hand(pages, labels):
    """Counting and shrinking with dictionaries."""
    good = {}
    for i, q, _ in labels:
        if i is not None and q is not None:
            good[i] = min(good.get(i, 1), int(q > 0))
    n, g, hosts = Counter(), Counter(), set()
    for i, url in pages:
        host = parts_by_hand(url)[0]
        hosts.add(host)
        for level in (("h", host), ("d", ".".join(host.split(".")[-2:])), ("s", host.split(".")[-1]), ("w", "")):
            n[level] += i in good
            g[level] += good.get(i, 0)
    whole = (g["w", ""] + 1) / (n["w", ""] + 2)
    sites = [(n[k], g[k]) for k in list(n) if k[0] == "d" and n[k]]
    total, hits = sum(a for a, _ in sites), sum(b for _, b in sites)
    mean = hits / total
    between = sum(b * b * 1000 // a for a, b in sites) / 1000 - hits * mean
    within = mean * (1 - mean)
    free = len(sites) - 1
    ratio = (between - free * within) / (within * (total - sum(a * a for a, _ in sites) / total - free))
    low, high, _ = rp.STRENGTHS
    worth = high if ratio <= 0 else max(low, min(high, math.floor((1 - ratio) / ratio + 0.5)))
    out = {}
    for host in hosts:
        p = whole
        for level in (("s", host.split(".")[-1]), ("d", ".".join(host.split(".")[-2:])), ("h", host)):
            p = (g[level] + worth * p) / (n[level] + worth)
        count = n["h", host]
        out[host] = (count, g["h", host], p, p + rp.BOUND_SD * math.sqrt(p * (1 - p) / (count + worth + 1)))
    return out


def test_posteriors_by_hand(spark):
    names = ["a.x.com", "b.x.com", "y.com", "spam.z.net", "c.z.net", "w.org", "", "only.net"]
    pages = [(i, f"http://{names[i % 7]}/{i}" if i % 7 != 6 else None) for i in range(400)]
    pages += [(1000, "http://only.net/"), (3, "http://y.com/again"), (None, "http://w.org/")]
    labels = [(i, 0 if i % 7 == 3 else int(i % 5 != 0), 0) for i in range(350)] + [(2, 0, 0), (9, None, 0)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["host"]: tuple(r)[1:] for r in rp.host_reputation(df, lab).collect()}
    want = reputation_by_hand(pages, labels)
    assert got.keys() == want.keys()
    for host, row in want.items():
        assert got[host] == pytest.approx(row, abs=1e-12)
    assert {r["verdict"] for r in rp.judge_urls(df, lab).filter("host = 'spam.z.net'").collect()} == {"block"}


def test_empty_tables_and_repeats(spark, labels):
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (2, "http://b.org/x")],
                                  "page_id long, url string")
    assert rp.judge_urls(pages.limit(0), labels).count() == 0
    none = rp.judge_urls(pages, labels.limit(0))
    assert plain(none, "page_id", "verdict") == [(1, "allow"), (1, "allow"), (2, "allow")]


@pytest.mark.parametrize("host, domain, suffix", [
    ("www.bbc.co.uk", "bbc.co.uk", "co.uk"), ("bbc.co.uk", "bbc.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"),
    ("a.b.example.com", "example.com", "com"), ("example.com", "example.com", "com"), ("com", "com", "com"),
    ("", "", ""), ("x.user.github.io", "user.github.io", "github.io"), ("notgithub.io", "notgithub.io", "io"),
    ("a.b.s3.amazonaws.com", "b.s3.amazonaws.com", "s3.amazonaws.com"), ("x.amazonaws.com", "amazonaws.com", "com"),
    ("..com", ".com", "com"),
])
def test_registered_domains(spark, host, domain, suffix):
    row = spark.createDataFrame([(host,)], "h string").select(*rp.levels(F.col("h"))).first()
    assert tuple(row) == (domain, suffix)


def test_posteriors_block_bad_owners_and_spare_their_neighbours(spark):
    """Owners under one public suffix are sites of their own; hosts inherit from their owner."""
    hosts = ["spam.co.uk", "w1.spam.co.uk", "w2.spam.co.uk", "good.co.uk", "www.good.co.uk", "other.co.uk"]
    pages, labels = [], []
    for i in range(600):
        host = hosts[i % 6]
        pages.append((i, f"http://{host}/{i}"))
        if host not in ("w2.spam.co.uk", "other.co.uk"):
            labels.append((i, int("spam" not in host or i % 36 == 0), 0))
    found = rp.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                          spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    verdicts = {r["host"]: r["verdict"] for r in found.collect()}
    assert verdicts == {h: "block" if "spam" in h else "allow" for h in hosts}
    flat = rp.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                         spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), suffixes=())
    means = rp.host_reputation(spark.createDataFrame(pages, "page_id long, url string"),
                               spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    mean = {r["host"]: r["mean"] for r in means.collect()}
    assert mean["w2.spam.co.uk"] < mean["other.co.uk"] < mean["good.co.uk"]
    assert flat.count() == 600
