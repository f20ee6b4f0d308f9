"""URL rules against plain string work, reputations against the formula."""

import numpy as np
import pytest
from conftest import DATA
from rowloom.llm.urls import RULES, beta_cdf, filter_urls, host_reputation, outcomes_of


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for sign in "/?#":
        host = host.split(sign)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (best.name, best.verdict) if best else (None, None)


def check(pages, outcomes):
    expected = sorted(((r["page_id"], *parsed(r["url"])) for r in pages.collect()), key=str)
    rows = filter_urls(pages, outcomes).collect()
    assert sorted(((r["page_id"], r["host"], r["path"]) for r in rows), key=str) == expected
    for r in rows:
        rule, verdict = ruled(r["host"], r["path"])
        assert r["rule"] == rule
        assert r["verdict"] == (verdict or ("block" if r["over_limit"] >= 0.9 else "allow"))


def test_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    check(pages, outcomes_of(pages, spark.read.parquet(f"{DATA}/labels.parquet")))


def test_odd_urls(spark):
    urls = [
        None, "", "example.org/es/1", "http://", "http:///x", "HTTP://A.EXAMPLE.ORG/ES/1", "http://a.example.org/es/1?x",
        "http://notexample.org/en/12", "http://example.org/en/12#y", "http://org", "http://org/", "http://x.com/fr/", "x://b.com/de/a",
        "http://É.com/de/", "http://a.com?u=http://b.org/", "http://a.com#/fr/", "http://u:p@a.com:80/fr/\n/x", "a://b://c/d", "http://bad.net/1", "http://bad.net/1",
    ]
    rows = [(k, u, "t", 1, 0.0, "r") for k, u in enumerate(urls)] + [(None, "http://bad.net/2", "t", 1, 0.0, "r")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, n int, bad_share double, rule string")
    outcomes = spark.createDataFrame([("http://bad.net/1", 1)] * 80 + [("http://x.com/", 0)] * 5 + [(None, 1)], "url string, bad int")
    check(pages.select("page_id", "url"), outcomes)
    check(pages, outcomes)
    found = {r["host"]: r["verdict"] for r in filter_urls(pages, outcomes).collect()}
    assert found["bad.net"] == "block"
    assert filter_urls(pages.limit(0), outcomes).count() == 0
    assert {r["verdict"] for r in filter_urls(pages, outcomes.limit(0)).collect() if r["rule"] is None} == {"allow"}


def test_hosts_shrink_to_their_domain(spark):
    rows = [(f"h{k}.bad.net", 1) for k in range(20) for _ in range(5)] + [(f"h{k}.good.net", 0) for k in range(20) for _ in range(5)]
    rows += [("new.bad.net", None), ("new.good.net", None), ("h0.bad.net", 0), ("other.org", None)]
    found = {r["host"]: r for r in host_reputation(spark.createDataFrame(rows, "host string, bad bigint")).collect()}
    assert found["new.bad.net"]["bad_share"] > 0.9 > 0.1 > found["new.good.net"]["bad_share"]
    assert found["h1.bad.net"]["bad_share"] > found["h0.bad.net"]["bad_share"] > 0.6
    assert 0.3 < found["other.org"]["bad_share"] < 0.7


@pytest.mark.parametrize("a, b", [(2.0, 3.0), (0.5, 0.5), (30.0, 20.0), (1000.0, 900.0), (5.0, 1.0)])
def test_beta_cdf(a, b):
    draws = np.random.default_rng(7).beta(a, b, 400_000)
    for x in (0.3, 0.5, 0.8):
        assert beta_cdf(x, np.array([a]), np.array([b]))[0] == pytest.approx((draws <= x).mean(), abs=4e-3)
