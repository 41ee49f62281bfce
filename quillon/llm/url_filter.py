"""URL filtering by host reputation, in DataFrame functions only.

Labelled page outcomes are counted by host, registered domain and suffix.  At
each level the share of bad pages has a beta prior around the posterior mean of
the level above (beta-binomial, strength by the method of moments), so a host
with few labelled pages is judged mostly as its domain, and a domain as its
suffix.  A URL is blocked where the lower bound of its host's posterior passes
a limit.  Rules (host and path prefixes) overrule the posterior.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

# Some suffixes of two labels under which names are registered; give a whole table where there is one.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "or.jp", "org.au", "org.uk")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reputation_name(host: Column) -> Column:
    """The host without port and without dots at its end."""
    return F.regexp_replace(host, r"\.*(:[0-9]*)?\z", "")


def is_address(name: Column) -> Column:
    """Whether it is an IPv4 or IPv6 address, which has no labels."""
    return name.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}\z") | name.startswith("[")


def last_labels(name: Column, n: int) -> Column:
    """The last ``n`` labels; empty where there are fewer."""
    return F.regexp_extract(name, r"(" + r"\.".join([r"[^.]*"] * n) + r")\z", 1)


def suffix_of(name: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The longest of ``suffixes`` (of two or three labels) that the name ends with, else its last label; an address is its own."""
    out = last_labels(name, 1)
    for n in (2, 3):
        held = [x for x in suffixes if x.count(".") == n - 1]
        if held:
            out = F.when(last_labels(name, n).isin(*held), last_labels(name, n)).otherwise(out)
    return F.when(is_address(name), name).otherwise(out)


def domain_of(name: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The suffix and the label before it; a name without one, or an address, is its own domain."""
    suffix = suffix_of(name, suffixes)
    before = F.regexp_extract(F.substring(name, F.lit(1), F.length(name) - F.length(suffix) - 1), r"([^.]*)\z", 1)
    return F.when(F.length(name) <= F.length(suffix) + 1, name).otherwise(F.concat(before, F.lit("."), suffix))


def _level(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Posterior counts ``a`` (bad) and ``b`` (good) of each child, shrunk to its parent's mean.

    The strength k of the prior solves the moments of the beta-binomial over
    all children: the spread of their shares beyond binomial noise is
    m (1 - m) / (k + 1).  It stays within 1 and 1000.
    """
    at = children.join(parents.select(F.col("name").alias(parent), (F.col("a") / (F.col("a") + F.col("b"))).alias("m")), parent)
    spread = at.agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), F.lit(2))).alias("seen"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("noise"),
        F.sum((F.col("n") - 1) * F.col("m") * (1 - F.col("m"))).alias("extra"),
    )
    rho = (F.col("seen") - F.col("noise")) / F.col("extra")
    k = F.coalesce(F.when((F.col("extra") > 0) & (rho > 0), F.least(F.lit(1000.0), F.greatest(F.lit(1.0), 1 / rho - 1))), F.lit(1000.0))
    return at.crossJoin(F.broadcast(spread.select(F.round(k, 6).alias("k")))).select("name", *[c for c in children.columns if c not in ("name",)], (F.col("k") * F.col("m") + F.col("bad")).alias("a"), (F.col("k") * (1 - F.col("m")) + F.col("n") - F.col("bad")).alias("b"))


def host_reputation(outcomes: DataFrame, base_strength: float = 2.0, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Posteriors by host, domain, suffix and for everything.

    ``outcomes`` has ``host`` and ``bad`` (0, 1 or null: not labelled, no part).
    Rows are summed by host before anything else moves.  With no outcome at
    all, everything is the even beta of ``base_strength``.
    """
    hosts = outcomes.where(F.col("bad").isNotNull()).groupBy(reputation_name(F.col("host")).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("name"), suffixes)).withColumn("suffix", suffix_of(F.col("name"), suffixes))
    hosts = written(hosts, "hosts")
    up = lambda df, to, *keep: df.groupBy(F.col(to).alias("name"), *keep).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = up(hosts, "domain", "suffix")
    suffixes = up(domains, "suffix").withColumn("all", F.lit(""))
    top = suffixes.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    half = F.lit(base_strength / 2)
    top = top.select(F.lit("").alias("name"), (F.col("bad") + half).alias("a"), (F.col("n") - F.col("bad") + half).alias("b"))
    by_suffix = written(_level(suffixes, top, "all"), "suffixes")
    by_domain = written(_level(domains, by_suffix, "suffix"), "domains")
    by_host = _level(hosts, by_domain, "domain")
    return by_host, by_domain, by_suffix, top


def lower_bound(a: Column, b: Column, z: float) -> Column:
    """The posterior's mean less ``z`` standard deviations."""
    mean = a / (a + b)
    return mean - F.lit(z) * F.sqrt(mean * (1 - mean) / (a + b + 1))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of ``rules`` (``host/path`` to verdict) that fits, or null.  A rule fits its host and that host's subdomains where the path starts with the rule's."""
    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)

    longest = sorted(rules, key=lambda r: (-len(r), r))
    return reduce(lambda rest, r: F.when(fits(r), F.lit(r)).otherwise(rest), reversed(longest), F.lit(None).cast("string"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str], limit: float = 0.25, z: float = 1.645, url: str = "url", suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``bad_mean`` and ``bad_bound`` to every row of ``pages``.

    A host without labelled pages takes its domain's posterior, then its
    suffix's, then the one over everything; ports and dots at a host's end
    don't count there, and addresses have neither domain nor suffix.
    ``suffixes`` are those of more than one label.  Null and malformed URLs have empty
    host and path and are judged like any host; URLs of any length are read
    whole; repeated rows are judged alike; an empty table gives no rows.  Columns of these names in
    ``pages`` are replaced.  The reputation tables hold a row for each host;
    they are joined, never collected; hot hosts are one row there, and the join
    is one that Spark splits by itself.
    """
    added = ["host", "path", "rule", "verdict", "bad_mean", "bad_bound"]
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in added]
    at = pages.select(*keep, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    at = at.withColumn("__q_name", reputation_name(F.col("host")))
    at = at.withColumn("__q_domain", domain_of(F.col("__q_name"), suffixes)).withColumn("__q_suffix", suffix_of(F.col("__q_name"), suffixes))
    for k, (level, on) in enumerate(zip(host_reputation(outcomes, suffixes=suffixes), ("__q_name", "__q_domain", "__q_suffix", None), strict=True)):
        level = level.select(F.col("name").alias(on or "__q_all"), F.col("a").alias(f"__q_a{k}"), F.col("b").alias(f"__q_b{k}"))
        at = at.join(level, on, "left") if on else at.crossJoin(F.broadcast(level))
    a, b = (F.coalesce(*[F.col(f"__q_{x}{k}") for k in range(4)]) for x in "ab")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    bound = lower_bound(a, b, z)
    judged = F.when(bound > limit, F.lit("block")).otherwise(F.lit("allow"))
    verdicts = reduce(lambda rest, r: F.when(F.col("rule") == r, F.lit(rules[r])).otherwise(rest), rules, judged)
    out = at.withColumn("rule", rule).withColumn("bad_mean", a / (a + b)).withColumn("bad_bound", bound).withColumn("verdict", verdicts)
    return out.select(*keep, *added)
