"""URL filters: rules first, then empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host and shrunk through a chain of
beta-binomial priors: suffix (`com`), registered domain (`example.com`), host
(`www.example.com`). Each level's prior has the mean of the level above and a
strength fitted by moments over all its members, and never more than the
evidence behind that mean. A url is blocked if the posterior bound says with the
stated confidence that the bad share of its host is above the limit, a multiple
of the share of all labelled pages. So a host without evidence is allowed, and so
are all hosts if they differ by no more than chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import materialize

#: Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Second labels that form a suffix with a two-letter country code.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    labels = F.split(host, r"\.")
    last, second = F.element_at(labels, -1), F.try_element_at(labels, F.lit(-2))
    two = (F.length(last) == 2) & second.isin(*SECOND_LEVEL)
    return F.when(two, F.concat_ws(".", second, last)).otherwise(last)


def domain_of(host: Column) -> Column:
    labels, depth = F.split(host, r"\."), F.size(F.split(suffix_of(host), r"\.")) + 1
    return F.when(F.size(labels) >= depth, F.array_join(F.slice(labels, -depth, depth), ".")).otherwise(host)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, at, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(prefix)
        rule, verdict = F.when(fits, at + prefix).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray, steps: int = 200) -> np.ndarray:
    """Regularised incomplete beta function by Lentz's continued fraction."""
    flip = x > (a + 1) / (a + b + 2)
    p, q, t = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    gamma = np.vectorize(math.lgamma, otypes=[float])
    front = np.exp(gamma(p + q) - gamma(p) - gamma(q) + p * np.log(t) + q * np.log1p(-t)) / p
    small = 1e-300
    c, d = np.ones_like(t), 1 - (p + q) * t / (p + 1)
    d = 1 / np.where(np.abs(d) < small, small, d)
    out = d.copy()
    for m in range(1, steps + 1):
        for k in (m * (q - m) * t / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * t / ((p + 2 * m) * (p + 2 * m + 1))):
            d, c = 1 + k * d, 1 + k / c
            d, c = 1 / np.where(np.abs(d) < small, small, d), np.where(np.abs(c) < small, small, c)
            out *= d * c
    return np.where(flip, 1 - front * out, front * out)


def beta_quantile(level: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low, high = np.full(len(a), 1e-12), np.full(len(a), 1 - 1e-12)
    for _ in range(50):
        mid = (low + high) / 2
        below = beta_cdf(mid, a, b) < level
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


def _bounds(level: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield x.assign(bad_low=beta_quantile(level, x.a.to_numpy(float), x.b.to_numpy(float)) if len(x) else [])

    return run


def _strength(mean: Column, least: float, most: float) -> Column:
    """Prior strength by moments from the spread of `bad / n` around `mean`, as one aggregate.

    With n pages a share p has variance p(1-p)/n * (1 + (n-1)/(s+1)); the sum of
    squared residuals over its expectation at s = infinity gives the excess.
    """
    rest = F.sum(F.when(F.col("n") > 0, F.pow(F.col("bad") - F.col("n") * mean, 2)))
    plain = F.sum(F.when(F.col("n") > 0, F.col("n") * mean * (1 - mean)))
    pairs = F.sum(F.when(F.col("n") > 0, F.col("n") * (F.col("n") - 1) * mean * (1 - mean)))
    excess = (rest - plain) / F.when(pairs > 0, pairs)
    fitted = F.when(excess > 0, 1 / excess - 1).otherwise(F.lit(most))
    return F.least(F.greatest(F.coalesce(fitted, F.lit(least)), F.lit(least)), F.lit(most))


def host_reputation(
    outcomes: DataFrame, *, confidence: float = 0.95, least_strength: float = 2.0, most_strength: float = 20.0
) -> DataFrame:
    """Per host: labelled pages `n`, `bad`, posterior `a`, `b` and the lower bound `bad_low` of the bad share.

    outcomes: host and bad (1, 0 or null where not labelled), a row per page.
    Pages are summed before they are shuffled; every later table has a row per
    host, domain or suffix. Empty outcomes give no hosts.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = materialize(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    root = hosts.agg((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5).alias("bad"), (F.coalesce(F.sum("n"), F.lit(0)) + 1.0).alias("n")).first()

    def shrink(level: DataFrame, mean: Column, weight: Column, out: str) -> DataFrame:
        """Posterior mean of each member, and the labelled pages that it stands for as `<out>_n`.

        The prior's strength `s` is one number for the level, but no more than what its mean stands for.
        """
        strength = float(level.agg(_strength(mean, least_strength, most_strength).alias("s")).first().s)
        level = level.withColumn("s", F.least(F.lit(strength), weight))
        return level.withColumns({f"{out}_mean": (F.col("bad") + F.col("s") * mean) / (F.col("n") + F.col("s")), f"{out}_n": F.col("n") + F.col("s")})

    by_suffix = shrink(suffixes, F.lit(root.bad / root.n), F.lit(float(root.n)), "suffix").select("suffix", "suffix_mean", "suffix_n")
    by_domain = shrink(domains.join(by_suffix, "suffix"), F.col("suffix_mean"), F.col("suffix_n"), "domain").select("domain", "domain_mean", "domain_n")
    by_host = shrink(hosts.join(by_domain, "domain"), F.col("domain_mean"), F.col("domain_n"), "host")
    s, m = F.col("s"), F.col("domain_mean")
    beta = by_host.select("host", "n", "bad", (F.col("bad") + s * m).alias("a"), (F.col("n") - F.col("bad") + s * (1 - m)).alias("b"))
    beta = beta.withColumn("base", F.lit(float(root.bad / root.n)))
    return beta.mapInPandas(_bounds(1 - confidence), "host string, n long, bad long, a double, b double, base double, bad_low double")


def judge(pages: DataFrame, outcomes: DataFrame, *, times: float = 1.5, most_bad: float = 0.9, rules: Sequence = RULES, **options: float) -> DataFrame:
    """Verdict per page: the longest fitting rule's, else by the host's posterior bound, against `times` the overall share, `most_bad` at most.

    pages: page_id, url. outcomes: page_id, bad. Several outcomes of a page
    count once (any bad makes it bad), repeated pages have the same; null ids have
    none. A null url has an empty host, judged like any other host; a very long
    one is matched whole. No pages give no rows; no outcomes allow all that no
    rule blocks; a bound equal to the limit is allowed. Extra columns of pages are
    left out.
    """
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    bad = outcomes.where("page_id is not null").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    known = host_reputation(pages.join(bad, "page_id", "left").select("host", "bad"), **options)
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_low") > F.least(times * F.col("base"), F.lit(most_bad)), "block").otherwise("allow")
    return pages.join(known.select("host", "n", "bad", "bad_low", "base"), "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, own).alias("verdict"),
        F.col("n").alias("host_labelled"), F.col("bad").alias("host_bad"), "bad_low",
    )
