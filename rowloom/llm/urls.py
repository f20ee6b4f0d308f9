"""URL filters: explicit rules, and the reputation of hosts from labelled pages by empirical Bayes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.shared import ship, store

#: A host is blocked when the share of bad pages exceeds LIMIT with this probability.
LIMIT, CONFIDENCE = 0.5, 0.9
#: Suffixes of more than one label under which domains are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.za")


@dataclass(frozen=True)
class Rule:
    """allow or block for a host with its subdomains, where the path begins with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        at_home = (host == self.host) | host.endswith(f".{self.host}")
        return at_home & path.startswith(self.path)


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z in lower case) and the path of a url; both empty where it is null or has no ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def suffix_of(host: Column) -> Column:
    """The part of a host under which domains are registered."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and the label before it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def beta_cdf(x: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """P(share <= x) for Beta(a, b), by the continued fraction of the incomplete beta function."""
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    log_beta = np.array([lgamma(u) + lgamma(v) - lgamma(u + v) for u, v in zip(p, q, strict=True)])
    front = np.exp(p * np.log(y) + q * np.log1p(-y) - log_beta) / p
    tiny = 1e-300
    c, d = np.ones_like(p), 1 / np.where(np.abs(1 - (p + q) * y / (p + 1)) < tiny, tiny, 1 - (p + q) * y / (p + 1))
    total = d.copy()
    for k in range(1, 2000):
        for term in (
            k * (q - k) * y / ((p + 2 * k - 1) * (p + 2 * k)),
            -(p + k) * (p + q + k) * y / ((p + 2 * k) * (p + 2 * k + 1)),
        ):
            d = 1 / np.where(np.abs(1 + term * d) < tiny, tiny, 1 + term * d)
            c = np.where(np.abs(1 + term / c) < tiny, tiny, 1 + term / c)
            total *= c * d
        if np.all(np.abs(c * d - 1) < 1e-12):
            break
    return np.where(swap, 1 - front * total, front * total)


def _strength(level: DataFrame) -> float:
    """How many pages a prior is worth: from the spread of the groups' bad pages around `mean` beyond chance.

    A group of n pages has n * m * (1 - m) * (1 + (n - 1) * r) as variance of its count, and strength is 1 / r - 1.
    """
    chance = F.col("mean") * (1 - F.col("mean"))
    spread = F.sum((F.col("bad") - F.col("n") * F.col("mean")) ** 2 - F.col("n") * chance)
    scale = F.sum(F.col("n") * (F.col("n") - 1) * chance)
    found, most = level.agg(spread, scale).first()
    r = min(max((found or 0.0) / most, 1e-3), 0.5) if most else 0.5
    return 1 / r - 1


def _posterior_means(level: DataFrame, name: str) -> DataFrame:
    strength = _strength(level)
    return level.select(name, ((strength * F.col("mean") + F.col("bad")) / (strength + F.col("n"))).alias("mean"))


def host_reputation(outcomes: DataFrame, limit: float = LIMIT) -> DataFrame:
    """host, n, bad, bad_share and over_limit of rows (host, bad), where bad is 1, 0 or null (not labelled).

    The prior of a suffix is the corpus's share of bad pages, that of a registered domain its suffix's posterior mean
    and that of a host its domain's; each level's strength comes from how its groups spread around their priors. So a
    host without labelled pages has its domain's reputation. over_limit is the chance that the share of bad pages is
    above `limit`. Counts are summed before they are shuffled; two numbers a level reach the driver.
    """
    ship(outcomes.sparkSession)
    totals = [F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")]
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    hosts = outcomes.groupBy("host").agg(*totals)
    hosts = store(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    mean = (bad + 0.5) / (n + 1.0) if n else 0.5
    suffixes = _posterior_means(hosts.groupBy("suffix").agg(*sums).withColumn("mean", F.lit(mean)), "suffix")
    domains = _posterior_means(hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix"), "domain")
    level = hosts.join(domains, "domain")
    strength = _strength(level)
    level = level.select(
        "host",
        "n",
        "bad",
        (strength * F.col("mean") + F.col("bad")).alias("worse"),
        (strength * (1 - F.col("mean")) + F.col("n") - F.col("bad")).alias("better"),
    )

    @F.pandas_udf("double")
    def above(worse: pd.Series, better: pd.Series) -> pd.Series:
        return pd.Series(1.0 - beta_cdf(limit, worse.to_numpy(float), better.to_numpy(float)))

    share = F.col("worse") / (F.col("worse") + F.col("better"))
    return level.select("host", "n", "bad", share.alias("bad_share"), above("worse", "better").alias("over_limit"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = RULES,
    key: str = "page_id",
    url: str = "url",
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """key, host, path, rule, verdict, bad_share, over_limit for each row of pages.

    `outcomes` has rows (url, bad) of labelled pages. The longest rule that fits a url gives the verdict (ties: the
    one listed first), else its host's reputation: block where over_limit is at least `confidence`.

    A url that is null or has no :// has an empty host and path, no rule and the empty host's reputation. Rows that
    repeat are judged each and count each; a null key stays null. Other columns are not read. An empty table gives an
    empty result.
    """
    host, path = host_and_path(F.col(url))
    judged = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    labelled = outcomes.select(host_and_path(F.col("url"))[0].alias("host"), F.col("bad").cast("bigint").alias("bad"))
    seen = judged.select("host", F.lit(None).cast("bigint").alias("bad")).union(labelled)
    reputation = host_reputation(seen).select("host", "bad_share", "over_limit")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):  # later ones win
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, F.lit(r.name)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    by_host = F.when(F.col("over_limit") >= confidence, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(reputation, "host").select(
        F.col("key").alias(key),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, by_host).alias("verdict"),
        "bad_share",
        "over_limit",
    )


def outcomes_of(pages: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """url and bad (1, 0) of the pages whose last path number is the doc_id of a labelled document.

    A page is bad where its document is of bad quality or toxic; a document with several labels counts as bad if one
    of them says so.
    """
    number = F.regexp_extract(host_and_path(F.col(url))[1], r"/(\d{1,18})(?:\.\w+)?/?\z", 1)
    numbered = pages.select(F.col(url).alias("url"), number.alias("n"))
    numbered = numbered.select("url", F.expr("try_cast(n AS BIGINT)").alias("doc_id"))
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad")
    return numbered.join(labels.groupBy("doc_id").agg(bad), "doc_id").select("url", "bad")
