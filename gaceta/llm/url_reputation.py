"""Host reputation by empirical Bayes: host, registered domain and suffix shrink in turn.

Built-in expressions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaceta import session
from gaceta.llm import columns, shrinkage

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class ReputationParams:
    # (verdict, host, path start) of fixed rules; a host covers its subdomains.
    rules: tuple[tuple[str, str, str], ...] = (
        (ALLOW, "org", "/"),
        (BLOCK, "example.org", "/es/"),
        (BLOCK, "example.org", "/en/1"),
        (ALLOW, "com", "/fr/"),
        (BLOCK, "com", "/de/"),
    )
    # Suffixes of two labels under which domains are registered.
    two_label_suffixes: tuple[str, ...] = (
        "ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
        "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
    )
    # A host is blocked when its rate of bad pages exceeds this by ``z`` posterior deviations.
    max_bad_rate: float = 0.3
    z: float = 1.645


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#``; A-Z lowered."""
    return columns.ascii_lower(
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_and_domain(host: Column, params: ReputationParams) -> tuple[Column, Column]:
    """Public suffix and registered domain of a host; an address is its own domain."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    address = bare.rlike(r"^[0-9]+(\.[0-9]+){3}$") | bare.startswith("[")
    tail = lambda labels: F.substring_index(bare, ".", -labels)
    two = tail(2).isin(*params.two_label_suffixes)
    suffix = F.when(address, "").when(two, tail(2)).otherwise(tail(1))
    return suffix, F.when(address, bare).when(two, tail(3)).otherwise(tail(2))


def rule_of(host: Column, path: Column, params: ReputationParams) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, start in sorted(params.rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(start)
        rule = F.when(fits, rule_host + start).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_bounds(
    hosts: DataFrame, params: ReputationParams = ReputationParams(),
) -> DataFrame:
    """(host, bad_bound) from (host, suffix, domain, n, k): k bad ones among n labelled pages.

    The overall rate is the prior of suffixes, a suffix' posterior mean the prior of its
    domains, a domain's that of its hosts; a group's own pages are left out of the prior
    it is judged by, so none counts twice. The strength of each prior comes from the
    spread between the groups of that level. A host without labels gets its domain's rate.
    """
    def sums(keys: list[str], name: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("n").alias(f"n_{name}"), F.sum("k").alias(f"k_{name}"))

    suffixes, domains = sums(["suffix"], "suffix"), sums(["suffix", "domain"], "domain")
    suffix_mean, suffix_strength = shrinkage.beta_prior(suffixes, "n_suffix", "k_suffix")
    _, domain_strength = shrinkage.beta_prior(domains, "n_domain", "k_domain")
    _, host_strength = shrinkage.beta_prior(hosts, "n", "k")
    n, k = F.col("n"), F.col("k")
    suffix = shrinkage.posterior_mean(
        F.col("n_suffix") - F.col("n_domain"), F.col("k_suffix") - F.col("k_domain"),
        suffix_mean, suffix_strength)
    domain = shrinkage.posterior_mean(
        F.col("n_domain") - n, F.col("k_domain") - k, suffix, domain_strength)
    bound = shrinkage.lower_bound(n, k, domain, host_strength, params.z)
    rated = hosts.join(domains, ["suffix", "domain"]).join(suffixes, "suffix")
    return rated.select(
        "host", F.round(bound, 6).alias("bad_bound"),
        F.when(bound > params.max_bad_rate, BLOCK).otherwise(ALLOW).alias("reputation"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, params: ReputationParams = ReputationParams(),
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_bound) for every row of ``pages``.

    ``outcomes`` is (page_id, bad boolean); where it repeats an id, one bad row makes the
    page bad; null outcomes count as no label. A null url, or one without ``://``, has the
    empty host and path; those pages share one reputation. Repeated pages are returned and
    counted one by one; a page without id has no label. Other columns are not read.
    """
    urls = session.materialize(pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    labels = (
        outcomes.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
        .groupBy("page_id").agg(F.max("bad").alias("bad")))
    suffix, domain = suffix_and_domain(F.col("host"), params)
    hosts = session.materialize(
        urls.select("page_id", "host").join(labels, "page_id", "left")
        .groupBy("host").agg(F.count("bad").alias("n"), F.count_if("bad").alias("k"))
        .select("host", suffix.alias("suffix"), domain.alias("domain"), "n", "k"))
    bounds = session.materialize(host_bounds(hosts, params))
    rule, verdict = rule_of(F.col("host"), F.col("path"), params)
    return session.lookup_join(urls, bounds, "host", spread="page_id").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, "reputation").alias("verdict"), "bad_bound")
