"""URL filters: rules by host and path, and empirical-Bayes host reputation; DataFrame functions only.

A host's labelled pages are good or bad outcomes. Its share of good pages has a beta prior whose
mean is the posterior mean of its registered domain, which is shrunk in turn to its suffix and that to
all pages. Each level's prior weight is estimated from how much the shares of its members differ
(moments of the beta-binomial). A url that no rule fits is blocked when the upper posterior bound of its
host's share of good pages stays under `LEAST_GOOD`: hosts with few labelled pages keep the
benefit of the doubt.

Only (suffix, domain, host, counts) rows are grouped and joined, one a host; a host with a third of all pages
is counted in the map tasks first. The rules are a short list given by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Suffixes of two labels under which names are registered (fixed values, not a complete list).
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "co.jp", "ne.jp", "or.jp", "com.au", "net.au", "org.au",
    "co.nz", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za",
)
LEAST_GOOD, BOUND = 0.5, 1.645
#: Prior weights in labelled pages: one where members do not differ at all, and one at least.
MOST_WEIGHT, LEAST_WEIGHT = 1000.0, 1.0


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query (fixed values).
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """The public suffix and the registered domain (one label more); the host itself where it has no more labels."""
    bare = F.regexp_replace(F.regexp_replace(host, r":\d*$", ""), r"\.$", "")
    two = F.substring_index(bare, ".", -2)
    is_two = two.isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(is_two, two).otherwise(F.substring_index(bare, ".", -1))
    return suffix, F.when(is_two, F.substring_index(bare, ".", -3)).otherwise(two)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """A struct (text, verdict) of the longest rule that fits, null if none; of equal lengths the first."""
    fits = F.lit(None).cast("struct<text:string,verdict:string>")
    # From short to long, so that the longest is asked first; sorted() keeps the first of equals last.
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        matches = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        fits = F.when(matches, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(fits)
    return fits


def prior_weight(mean: Column) -> Column:
    """An aggregate over a parent's children (n labelled, k good): the beta prior's weight by the method of moments."""
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    # Expected squared deviation of a child's share: m(1-m) (1/n + (1-1/n) / (weight+1)).
    spread = F.sum(n * F.pow(k / n - mean, 2))
    own, room = F.sum(mean * (1 - mean)), F.sum(mean * (1 - mean) * (n - 1))
    likeness = (spread - own) / F.when(room > 0, room)
    weight = F.when(likeness > 0, 1 / likeness - 1).otherwise(F.lit(MOST_WEIGHT))
    return F.least(F.greatest(F.coalesce(weight, F.lit(MOST_WEIGHT)), F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT))


def shrunk(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The children with mean and prior weight: their share shrunk to the parent's mean."""
    named = parents.select(F.col(key).alias("_parent"), F.col("mean").alias("_mean"))
    joined = children.join(named, F.col(key).eqNullSafe(F.col("_parent"))).drop("_parent")
    weights = joined.where("n > 0").groupBy(F.col(key).alias("_parent")).agg(
        prior_weight(F.col("_mean")).alias("_weight")
    )
    joined = joined.join(weights, F.col(key).eqNullSafe(F.col("_parent")), "left").drop("_parent")
    weight = F.coalesce("_weight", F.lit(MOST_WEIGHT))
    mean = (F.col("k") + weight * F.col("_mean")) / (F.col("n") + weight)
    return joined.withColumns({"mean": mean, "weight": weight}).drop("_mean", "_weight")


def reputations(outcomes: DataFrame) -> DataFrame:
    """(host, n, k, mean, weight, upper) for hosts of `outcomes` (host, good: 1, 0 or null for an unlabelled page).

    Without labelled pages the overall mean is 1, so that nothing is blocked for want of knowledge.
    """
    suffix, domain = suffix_and_domain(F.col("host"))
    counts = [F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k")]
    hosts = outcomes.groupBy("host").agg(*counts).withColumns({"suffix": suffix, "domain": domain})
    again = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("suffix", "domain").agg(*again)
    suffixes = domains.groupBy("suffix").agg(*again).withColumn("whole", F.lit(1))
    whole = suffixes.groupBy("whole").agg(*again)
    # One good page beforehand, so that the mean is defined and never 0.
    whole = whole.withColumn("mean", (F.col("k") + 1.0) / (F.col("n") + 1.0))
    suffixes = shrunk(suffixes, whole, "whole").select("suffix", "mean")
    domains = shrunk(domains, suffixes, "suffix").select("domain", "mean")
    hosts = shrunk(hosts, domains, "domain")
    seen = F.col("n") + F.col("weight")
    upper = F.least(F.lit(1.0), F.col("mean") + BOUND * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (seen + 1)))
    return hosts.select("host", "n", "k", "mean", "weight", upper.alias("upper"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good) of every page: the quality label with the page's id, the smaller where labels differ."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(F.min("quality").alias("good"))
    host, _ = host_and_path(F.col("url").cast("string"))
    return pages.select("page_id", host.alias("host")).join(known, "page_id", "left").select("host", "good")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, upper) of every row of `pages`.

    A null url or one without :// has an empty host and path; all such pages share that host's
    reputation. Null and repeated page ids are judged row by row; other columns are not read.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    read = pages.select("page_id", host.alias("host"), path.alias("path"))
    upper = reputations(page_outcomes(pages, labels)).select("host", "upper")
    fits = longest_rule(rules, F.col("host"), F.col("path"))
    judged = read.join(upper, "host", "left").withColumn("fits", fits)
    own = F.when(F.col("upper") < LEAST_GOOD, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("fits.text").alias("rule"), F.coalesce("fits.verdict", own).alias("verdict"), "upper"
    )
