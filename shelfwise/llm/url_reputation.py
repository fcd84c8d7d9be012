"""URL filter with empirical-Bayes host reputation.

Labelled page outcomes (1 good, 0 bad) are counted per host, registered domain
and suffix. Beta-binomial shrinkage runs down that tree: the suffix is shrunk
to the corpus rate, the domain to its suffix, the host to its domain. The
strength of each level's prior is estimated from the spread of its units
(method of moments, one pass of sums), so levels whose units differ little
pull strongly. A host is judged by a lower or upper posterior bound, and an
explicit rule list overrides the judgement.

Only DataFrame functions are used. Pages are pre-aggregated per host before
any other shuffle; the rules are a short list given by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: posterior standard deviations of the bound
BOUND_Z = 1.64
#: a host is blocked when even the upper bound of its good rate is below this share of the corpus rate
MIN_SHARE = 0.97
#: bounds of the estimated prior strengths (pseudo-observations)
MIN_STRENGTH, MAX_STRENGTH = 2.0, 10000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """Registered domain: the last two labels. (A public-suffix list would be
    a parameter table; the last label is taken as the suffix.)"""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(verdict, rule) of the longest fitting rule, or nulls. A rule
    ``host/path`` fits its host and all subdomains when the url's path starts
    with the rule's. Equal lengths: the first given wins."""
    verdict, rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = text.partition("/")
        rule_host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rule_host)
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        # sorted() is stable: of equal lengths the first given wins
        longer = rule.isNull() | (F.length(rule) < len(text))
        verdict = F.when(fits & longer, what).otherwise(verdict)
        rule = F.when(fits & longer, text).otherwise(rule)
    return verdict, rule


def _level(prior: Column) -> Column:
    """Strength of the beta prior whose mean is each unit's parent rate, by
    moments: with n_i outcomes of rate p_i around parent rate m_i, the excess
    of sum n_i (p_i - m_i)^2 over its binomial expectation gives the
    between-unit variance share rho, and the strength is 1 / rho - 1."""
    n, p = F.col("n").cast("double"), F.col("good") / F.col("n")
    spread = F.sum(n * (p - prior) * (p - prior))
    within = F.sum(prior * (1.0 - prior))
    weight = F.sum((n - 1.0) * prior * (1.0 - prior))
    rho = F.when(weight > 0, (spread - within) / weight)
    strength = F.when(rho > 0, 1.0 / rho - 1.0).otherwise(MAX_STRENGTH)
    return F.coalesce(F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), strength)), F.lit(MAX_STRENGTH))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of every host in ``outcomes`` (columns ``host`` and
    ``outcome`` 1/0/null; null outcomes count the host only).

    Returns host, n, good, rate (posterior mean), lower, upper (posterior
    bounds, normal approximation of the beta posterior, BOUND_Z deviations)."""
    hosts = (outcomes.groupBy("host")
             .agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).cast("long").alias("good"))
             .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    hosts = stage(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    # the corpus rate, with one good and one bad pseudo-outcome
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = ((total["good"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)

    def shrink(units: DataFrame, prior: Column, name: str) -> DataFrame:
        strength = units.where("n > 0").agg(_level(prior).alias("s")).first()["s"]
        return units.withColumn(f"{name}_k", F.lit(strength)).withColumn(
            f"{name}_rate", (F.col("good") + F.lit(strength) * prior) / (F.col("n") + F.lit(strength)))

    s = shrink(suffixes, F.lit(rate), "suffix").select("suffix", "suffix_rate")
    d = shrink(domains.join(s, "suffix"), F.col("suffix_rate"), "domain").select("domain", "domain_rate")
    h = shrink(hosts.join(d, "domain"), F.col("domain_rate"), "host")
    a = F.col("host_rate") * (F.col("n") + F.col("host_k"))
    size = F.col("n") + F.col("host_k")
    sd = F.sqrt(a * (size - a) / (size * size * (size + 1.0)))
    return h.select("host", "n", "good", F.col("host_rate").alias("rate"),
                    F.greatest(F.lit(0.0), F.col("host_rate") - BOUND_Z * sd).alias("lower"),
                    F.least(F.lit(1.0), F.col("host_rate") + BOUND_Z * sd).alias("upper"),
                    F.lit(rate).alias("corpus_rate"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = (),
               id_col: str = "page_id", url_col: str = "url", min_share: float = MIN_SHARE) -> DataFrame:
    """One row per page: ``id_col``, host, path, rule, verdict, host_rate.

    ``outcomes``: (``id_col``, outcome) of labelled pages, 1 good and 0 bad;
    several outcomes of one page count as their minimum; outcomes of unknown
    pages and null outcomes are ignored. The rule decides where one fits, else
    the host is blocked when the upper posterior bound of its good rate is
    below ``min_share`` times the corpus rate. Null urls and urls without
    ``://`` have an empty host and path and are judged by the pool of those.
    Repeated rows are returned as often as given; other columns are ignored;
    an empty table gives an empty result; without labels every url is allowed
    unless a rule says otherwise."""
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("u"))
    p = p.select("page_id", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    marks = outcomes.where(F.col("outcome").isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        F.min(F.col("outcome").cast("int")).alias("outcome"))
    labelled = p.join(marks, F.col("page_id") == F.col("label_id"), "left").select("host", "outcome")
    rep = host_reputation(labelled).select(
        "host", F.col("rate").alias("host_rate"),
        F.when(F.col("upper") < F.lit(min_share) * F.col("corpus_rate"), "block").otherwise("allow").alias("judged"))
    out = p.join(rep, "host", "left")
    verdict, rule = best_rule(F.col("host"), F.col("path"), rules)
    return out.select(F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"),
                      F.coalesce(verdict, F.col("judged"), F.lit("allow")).alias("verdict"),
                      F.round("host_rate", 6).alias("host_rate"))
