"""Quality rules on documents and on their hosts, with DataFrame functions only.

Rule failures are counted by host, each host's failure rate is shrunk towards the corpus
by a beta prior fitted to all hosts (moments of the beta-binomial), and the verdicts are
joined back.  A host is bad if even the lower bound of its rate is over ``BAD_RATE``.  A
document goes if it fails a base rule, or if it breaks a softer rule on a bad host; clean
documents stay on any host.

* Null and empty texts have no words, so they fail the base rules.
* Documents without a host form one host of their own.
* Repeated rows are judged and counted as often as they occur; an empty table stays empty.
* Two different three-word windows of one text share a 64-bit hash with a chance of about
  n^2 / 2^65; where no two windows do, which is checked first, none is repeated.
* Hosts are counted before they are exchanged; verdicts are joined as Spark sees fit, and a
  host with a third of all rows is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import unused, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Softer rules: symbols per 100 characters of words, repeated lines per 100 lines.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: Verdict on hosts.
BAD_RATE = 0.5
BOUND_SD = 2.0
#: Limits of the correlation within groups that a prior is fitted to: it weighs as much as
#: 4 to 99 observations, so that a document or two never decide.
MIN_RHO, MAX_RHO = 0.01, 0.2

SPACE = r"[\x20\x09-\x0D]+"
#: Columns that the operator adds.
VERDICTS = ("base_failed", "soft_failed", "host_rate", "host_bad", "kept")
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _windows(words: Column, n_words: Column) -> Column:
    """A hash of the three words from each place on."""
    places = F.when(n_words >= 3, F.sequence(F.lit(0), n_words - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))


def _covered(windows: Column, placed: Column) -> Column:
    """Words inside windows that occur twice; ``placed``: (hash, place) in order."""
    last = F.size(placed) - 1
    twice = F.filter(
        placed,
        lambda x, k: ((k > 0) & (placed[F.greatest(k - 1, F.lit(0))]["hash"] == x["hash"]))
        | ((k < last) & (placed[F.least(k + 1, last)]["hash"] == x["hash"])),
    )
    starts = F.sort_array(F.transform(twice, lambda x: x["place"]))
    state = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        starts,
        state,
        lambda s, x: F.struct(x.alias("last"), (s["total"] + F.least(x - s["last"], F.lit(3))).alias("total")),
        lambda s: s["total"],
    )


def add_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the five signals, base_failed and soft_failed, replacing columns of these names."""
    body, words, windows, placed, lines, count = unused(docs, "body_", "words_", "windows_", "placed_", "lines_", "count_")
    content = F.coalesce(docs[text], F.lit(""))
    trimmed = F.btrim(content, F.lit(" \t\n\x0b\x0c\r"))
    none = F.array().cast("array<string>")
    rows = docs.withColumn(body, trimmed)
    rows = rows.withColumn(words, F.when(F.col(body) == "", none).otherwise(F.split(body, SPACE)))
    rows = rows.withColumn(lines, F.filter(F.split(content, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn(count, F.size(words))
    rows = rows.withColumn(windows, _windows(F.col(words), F.col(count)))
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    pairs = F.transform(windows, lambda x, k: F.struct(x.alias("hash"), k.alias("place")))
    rows = rows.withColumn(placed, F.when(repeated, F.sort_array(pairs)))
    rows = rows.withColumn("n_words", F.col(count).cast("long"))
    rows = rows.withColumn("word_chars", F.length(F.regexp_replace(content, SPACE, "")).cast("long"))
    rows = rows.withColumn("n_symbols", F.length(F.regexp_replace(content, r"[^#*$%&|<>]+", "")).cast("long"))
    rows = rows.withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
    covered = _covered(F.col(windows), F.col(placed))
    rows = rows.withColumn("n_repeat_words", F.when(F.col(placed).isNull(), F.lit(0).cast("long")).otherwise(covered))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    soft = (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")) | (
        100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.size(lines)
    )
    rows = rows.withColumns({"base_failed": base, "soft_failed": soft})
    return rows.drop(body, words, windows, placed, lines, count)


def beta_prior(groups: DataFrame, n: str, failed: str) -> tuple[float, float]:
    """Mean and strength of a beta prior from (n, failed) of groups, by moments."""
    rate = F.col(failed) / F.col(n)
    sums = groups.agg(
        F.sum(n).alias("n"), F.sum(failed).alias("f"), F.sum(F.col(n) * F.col(n)).alias("nn"),
        F.sum(F.col(n) * rate * rate).alias("npp"), F.count("*").alias("groups"),
    ).first()
    if not sums.n:
        return 0.0, _strength(0.0, 0.0)
    mean, own = sums.f / sums.n, sums.groups - 1
    spread = mean * (1 - mean)
    return mean, _strength(sums.npp - sums.n * mean * mean - own * spread, (sums.n - sums.nn / sums.n - own) * spread)


def prior_strength(groups: DataFrame, n: str, failed: str, mean: str) -> float:
    """The same strength where each group has an expected rate ``mean`` of its own."""
    spread = F.col(mean) * (1 - F.col(mean))
    off = F.col(failed) / F.col(n) - F.col(mean)
    sums = groups.agg(
        F.sum(F.col(n) * off * off - spread).alias("more"), F.sum((F.col(n) - 1) * spread).alias("most")
    ).first()
    return _strength(sums.more or 0.0, sums.most or 0.0)


def _strength(more: float, most: float) -> float:
    """From the spread of rates beyond chance, and the spread if groups were all or nothing."""
    rho = more / most if most > 0 else 0.0
    return 1 / min(MAX_RHO, max(MIN_RHO, rho)) - 1


def host_verdicts(judged: DataFrame, host: str) -> DataFrame:
    """(host, host_docs, host_failed, host_rate, host_bad) from rows with the rules' results."""
    failure = (F.col("base_failed") | F.col("soft_failed")).cast("long")
    hosts = judged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_docs"), F.sum(failure).alias("host_failed"))
    hosts = written(hosts, "hosts")
    mean, strength = beta_prior(hosts, "host_docs", "host_failed")
    total = F.col("host_docs") + strength
    rate = (F.col("host_failed") + mean * strength) / total
    sd = F.sqrt(rate * (1 - rate) / (total + 1))
    return hosts.withColumns({"host_rate": rate, "host_bad": rate - BOUND_SD * sd > BAD_RATE})


def join_verdicts(judged: DataFrame, hosts: DataFrame, host: str) -> DataFrame:
    """Add host_rate, host_bad and kept to rows with the rules' results."""
    (own,) = unused(judged, "verdict_host")
    verdicts = hosts.select(F.col("host").alias(own), "host_rate", "host_bad")
    rows = judged.drop("host_rate", "host_bad", "kept")
    rows = rows.join(verdicts, rows[host].eqNullSafe(F.col(own))).drop(own)
    return rows.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_bad") & F.col("soft_failed")))


def judge(signalled: DataFrame, host: str = "source") -> DataFrame:
    """Rows of ``add_signals`` with their hosts' verdicts; the signals are computed once."""
    signalled = written(signalled, "signals")
    return join_verdicts(signalled, host_verdicts(signalled, host), host)
