"""URL filters: host rules, and reputations of hosts shrunk towards their domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import lower_ascii

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Endings under which names are registered one level deeper.
DEEP_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")

MIN_GOOD, Z = 0.5, 1.645  # a host's good share must be above this with 95 % probability
LEAST_WEIGHT, MOST_WEIGHT, UNKNOWN_WEIGHT = 1.0, 1e4, 10.0


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column) -> Column:
    parts = F.when(F.substring_index(host, ".", -2).isin(*DEEP_SUFFIXES), 3).otherwise(2)
    deep = F.substring_index(host, ".", -3)
    return F.when(parts == 3, deep).otherwise(F.substring_index(host, ".", -2))


def suffix(host: Column) -> Column:
    deep = F.substring_index(host, ".", -2)
    return F.when(deep.isin(*DEEP_SUFFIXES), deep).otherwise(F.substring_index(host, ".", -1))


def _fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    same_host = (host == name) | host.endswith(f".{name}")
    return same_host & path.startswith(slash + rest)


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, else null."""
    longest_first = sorted((rule for _, rule in rules), key=len, reverse=True)
    return F.coalesce(
        *[F.when(_fits(host, path, rule), F.lit(rule)) for rule in longest_first],
        F.lit(None).cast("string"),
    )


def _spread(level: DataFrame) -> float:
    """How many outcomes a parent's share is worth to its children: the beta-binomial
    concentration by the analysis of variance between and within them."""
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    sums = level.filter("n > 0").agg(
        F.count("*").cast("double").alias("groups"),
        F.sum(n).alias("rows"),
        F.sum(k).alias("good"),
        F.sum(n * n).alias("squares"),
        F.sum(k * k / n).alias("shares"),
    )
    groups, rows, good, squares, shares = sums.first()
    if groups < 2 or rows <= groups:
        return UNKNOWN_WEIGHT
    between = (shares - good * good / rows) / (groups - 1)
    within = (good - shares) / (rows - groups)
    size = (rows - squares / rows) / (groups - 1)
    whole = between + (size - 1) * within
    if whole <= 0:
        return UNKNOWN_WEIGHT
    alike = (between - within) / whole
    if alike <= 0:
        return MOST_WEIGHT
    return min(MOST_WEIGHT, max(LEAST_WEIGHT, 1 / alike - 1))


def host_reputations(hosts: DataFrame) -> DataFrame:
    """(host, n, k) with the posterior mean and lower bound of each host's good share.

    ``n`` outcomes, ``k`` of them good.  A share is shrunk towards its parent's:
    all pages, suffix, registered domain, host.  At each level the parent's share
    counts as many outcomes as the beta-binomial fit of that level says.  Three
    numbers, one for each level, go through the driver.
    """
    hosts = hosts.withColumn("domain", registered_domain(F.col("host")))
    hosts = hosts.withColumn("suffix", suffix(F.col("host")))
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    share = ((total["k"] or 0) + 1) / ((total["n"] or 0) + 2)
    w1, w2, w3 = _spread(suffixes), _spread(domains), _spread(hosts)

    up = (F.col("k") + F.lit(w1) * F.lit(share)) / (F.col("n") + F.lit(w1))
    suffixes = suffixes.select("suffix", up.alias("up"))
    mid = (F.col("k") + F.lit(w2) * F.col("up")) / (F.col("n") + F.lit(w2))
    domains = domains.join(suffixes, "suffix").select("domain", "suffix", mid.alias("mid"))
    a = F.col("k") + F.lit(w3) * F.col("mid")
    mean = a / (F.col("n") + F.lit(w3))
    error = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.lit(w3) + 1))
    return (
        hosts.join(domains, ["suffix", "domain"])
        .withColumn("mean", mean)
        .withColumn("bound", F.col("mean") - F.lit(Z) * error)
        .select("host", "n", "k", "mean", "bound")
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    min_good: float = MIN_GOOD,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``outcomes`` are (page_id, good); a page with several is good if all are.
    The longest rule that fits decides; else the host is allowed if the lower
    bound of its good share is at least ``min_good``.  A host without outcomes
    has its domain's share, and a wide bound.

    A null url, or one without ``://``, has an empty host and path; empty hosts
    are judged together as one host.  Repeated rows are judged alike and counted
    one by one; a null page_id has no outcome.  Very long urls are texts like others.
    An empty table gives no rows; without outcomes every host has the same wide bound.
    Only page_id and url are read.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = (
        outcomes.filter(F.col("good").isNotNull())
        .groupBy("page_id")
        .agg(F.min(F.col("good").cast("int")).alias("good"))
    )
    hosts = (
        parsed.join(known, "page_id", "left")
        .groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    )
    hosts = Scratch(pages.sparkSession, "reputation").save(hosts, "hosts")  # read five times
    judged = host_reputations(hosts).select("host", (F.col("bound") >= min_good).alias("fine"))
    rule = rule_column(F.col("host"), F.col("path"), rules)
    said = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)])
    by_host = F.when(F.col("fine"), "allow").otherwise("block")
    return (
        parsed.withColumn("rule", rule)
        .join(judged, "host")
        .withColumn("verdict", F.coalesce(F.try_element_at(said, F.col("rule")), by_host))
        .select("page_id", "host", "path", "rule", "verdict")
    )
