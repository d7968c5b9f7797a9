"""URL filters: rules first, then the host's reputation by empirical Bayes.

Labelled page outcomes (bad or not) are counted by host, registered domain and suffix.
From the top down, each level's rate is shrunk towards the posterior mean of the level
above by a beta prior whose strength is fitted to all groups of that level (moments of the
beta-binomial).  A host is blocked if even the lower bound of its posterior rate of bad
pages is over ``BAD_RATE``; a host without labels has its domain's expectation and the
prior's wide bound.

* Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; path: from there
  up to ``?``, ``#`` or the end; a null url, or one without ``://``, has both empty.
* The longest rule that fits wins; ties go to the block.  Rules are a list of at most
  ``MAX_RULES``, part of the expression; host counts are combined before they are exchanged, and
  verdicts are joined by host as Spark sees fit, with hot hosts split by adaptive execution.
* No labels at all: every host has the prior's rate and is allowed.  Rows, repeated ones
  too, stay as they are; an empty table stays empty.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import unused, written
from quotewright.llm.quality import beta_prior, prior_strength

MAX_RULES = 1000
BAD_RATE = 0.5
BOUND_SD = 1.64
#: Suffixes of two labels, under which domains are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")


def host_and_path(url: Column) -> tuple[Column, Column]:
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substr(url, mark + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix; a port doesn't belong to either."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    deep = two.isin(*TWO_LABEL_SUFFIXES)
    domain = F.when(deep, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, F.when(deep, two).otherwise(F.substring_index(name, ".", -1))


def rule_column(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest of (verdict, host/path) rules that fits, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda x: (len(x[1]), x[0] == "block")):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _shrunk(mean: Column, strength: float) -> Column:
    return (F.col("bad") + mean * strength) / (F.col("n") + strength)


def reputations(outcomes: DataFrame) -> DataFrame:
    """(host, labelled, bad_rate, bad_bound, blocked) from (host, n, bad) of all hosts."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = outcomes.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = written(hosts.groupBy("suffix").agg(*counts), "suffixes")
    mean, strength = beta_prior(suffixes.filter("n > 0"), "n", "bad")
    suffixes = suffixes.select("suffix", _shrunk(F.lit(mean), strength).alias("suffix_rate"))
    domains = written(hosts.groupBy("domain", "suffix").agg(*counts).join(suffixes, "suffix"), "domains")
    strength = prior_strength(domains.filter("n > 0"), "n", "bad", "suffix_rate")
    domains = domains.select("domain", _shrunk(F.col("suffix_rate"), strength).alias("domain_rate"))
    hosts = written(hosts.join(domains, "domain"), "hosts")
    strength = prior_strength(hosts.filter("n > 0"), "n", "bad", "domain_rate")
    rate = _shrunk(F.col("domain_rate"), strength)
    bound = rate - BOUND_SD * F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1))
    return hosts.select(
        "host", F.col("n").alias("labelled"), rate.alias("bad_rate"), bound.alias("bad_bound"), (bound > BAD_RATE).alias("blocked")
    )


def host_outcomes(pages: DataFrame, labels: DataFrame, host: str = "host", key: str = "key") -> DataFrame:
    """(host, n, bad) of every host in pages, from (key, bad) labels of page contents.

    Rows of pages count as often as ``times`` says, if they have it.  A content with several
    labels is bad if most of them are.
    """
    times = F.sum("times") if "times" in pages.columns else F.count("*")
    counted = written(pages.groupBy(F.col(host).alias("host"), F.col(key).alias("key")).agg(times.alias("times")), "contents")
    known = labels.groupBy(F.col("key").alias("label_key")).agg((F.avg(F.col("bad").cast("int")) > 0.5).cast("int").alias("bad"))
    rows = counted.join(known, F.col("key") == F.col("label_key"), "left")
    labelled = F.when(F.col("bad").isNotNull(), F.col("times")).otherwise(0)
    bad = F.when(F.col("bad") == 1, F.col("times")).otherwise(0)
    return written(rows.groupBy("host").agg(F.sum(labelled).alias("n"), F.sum(bad).alias("bad")), "outcomes")


def judge_urls(pages: DataFrame, hosts: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """All columns, then host, path, rule, verdict, bad_rate and bad_bound, which replace
    columns of the same names.

    ``hosts``: what ``reputations`` gives; a host that it lacks is allowed.
    """
    own, fit = unused(pages, "reputation_host", "fitting_rule")
    host, path = host_and_path(pages[url])
    added = ("host", "path", "rule", "verdict", "bad_rate", "bad_bound")
    rows = pages.drop(*added).withColumns({"host": host, "path": path})
    rows = rows.withColumn(fit, rule_column(F.col("host"), F.col("path"), rules))
    joined = rows.join(hosts.withColumnRenamed("host", own).drop("labelled"), F.col("host") == F.col(own), "left")
    method = F.when(F.coalesce(F.col("blocked"), F.lit(False)), "block").otherwise("allow")
    joined = joined.withColumn("rule", F.col(f"{fit}.rule")).withColumn("verdict", F.coalesce(F.col(f"{fit}.verdict"), method))
    return joined.select(*[f"`{c}`" for c in rows.columns if c != fit], "rule", "verdict", "bad_rate", "bad_bound")
