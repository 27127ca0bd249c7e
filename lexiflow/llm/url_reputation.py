"""URL filter by empirical-Bayes host reputation.

Labelled pages give good and bad outcomes per host. A host's bad rate is
shrunk through beta-binomial priors: host -> registered domain -> suffix ->
all pages. Each level's prior is a beta distribution whose mean is the parent's
posterior mean and whose strength is fitted by the method of moments over the
groups of that level. A page is blocked when the lower bound of its host's
posterior bad rate is above a limit. Explicit rules on host and path come
first.

Scale: labels and pages are counted by host with partial aggregation; every
further level aggregates the (much smaller) host table. The host table is
joined back by host: broadcast while its measured size is within the bounds of
``broadcast_if_small``, else a shuffled join whose hot hosts AQE splits.

Edge cases: a null url or one without ``://`` has empty host and path and fits
no rule; its reputation is that of the empty host. Null labels and null ids
are no outcome; several labels of one page are several outcomes. An empty
label table gives the prior mean 0.5 with strength 2 at every level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, write_table
from .common import ascii_lower


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # begins with /

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class ReputationConfig:
    #: block when the posterior bad rate is above ``max_bad_rate`` with this many standard deviations to spare
    max_bad_rate: float = 0.4
    z: float = 1.645
    #: bounds of a fitted prior strength (pseudo-outcomes)
    min_strength: float = 2.0
    max_strength: float = 1000.0
    #: suffixes of more than one label
    long_suffixes: Sequence[str] = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "com.cn")


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffix(host: Column, cfg: ReputationConfig) -> Column:
    """The last label, or a listed longer suffix; the port does not count."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    two = F.regexp_extract(bare, "([^.]+\\.[^.]+)$", 1)
    return F.when(two.isin(list(cfg.long_suffixes)), two).otherwise(F.regexp_extract(bare, "([^.]*)$", 1))


def registered_domain(host: Column, cfg: ReputationConfig) -> Column:
    """The suffix and one label before it (the host itself if it has no more)."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    two = F.regexp_extract(bare, "([^.]+\\.[^.]+)$", 1)
    three = F.regexp_extract(bare, "([^.]+\\.[^.]+\\.[^.]+)$", 1)
    deep = F.when(two.isin(list(cfg.long_suffixes)), three).otherwise(two)
    return F.when(deep == "", bare).otherwise(deep)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The name of the longest rule that fits, else null. ``rules`` is a short
    list given by the caller; it becomes part of the plan."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


def _shrink(groups: DataFrame, key: str, parent: str | None, cfg: ReputationConfig) -> DataFrame:
    """Add ``mean`` and ``strength`` of the posterior of each group.

    ``groups``: key, parent columns, ``n`` outcomes, ``bad`` of them, and
    ``pmean`` (posterior mean of the parent). The prior strength of the level
    is fitted by moments: with s2 the outcome-weighted mean of (rate - pmean)^2
    and v the same mean of pmean (1 - pmean), the share of variance between
    groups is rho = (s2 - v G / N) / (v (1 - G / N)) and the strength 1 / rho - 1,
    held within bounds (G groups with outcomes, N outcomes); it is the least one
    where no group has two outcomes to fit it with.
    """
    n, bad, pm = F.col("n").cast("double"), F.col("bad").cast("double"), F.col("pmean")
    seen = F.col("n") > 0
    moments = groups.where(seen).agg(
        F.count(F.lit(1)).cast("double").alias("_g"), F.sum(n).alias("_n"),
        F.sum(n * (bad / n - pm) * (bad / n - pm)).alias("_s"), F.sum(n * pm * (1 - pm)).alias("_v"))
    share = F.col("_g") / F.col("_n")
    v, s2 = F.col("_v") / F.col("_n"), F.col("_s") / F.col("_n")
    rho = F.when((v > 0) & (share < 1), (s2 - v * share) / (v * (1 - share)))
    raw = F.when(rho.isNull(), F.lit(cfg.min_strength)).when(rho > 0, 1 / rho - 1).otherwise(F.lit(cfg.max_strength))
    m = F.least(F.greatest(raw, F.lit(cfg.min_strength)), F.lit(cfg.max_strength))
    level = moments.select(m.alias("_m"))  # one row
    out = groups.join(F.broadcast(level))
    a, s = F.col("_m") * pm + bad, F.col("_m") + n
    return out.withColumn("mean", a / s).withColumn("strength", s).drop("_m")


def host_reputation(outcomes: DataFrame, hosts: DataFrame, cfg: ReputationConfig = ReputationConfig()) -> DataFrame:
    """Posterior per host: ``host, n, bad, mean, strength``.

    ``outcomes`` (host, bad 0/1) are labelled pages; ``hosts`` (host) all hosts
    that need a reputation, labelled or not.
    """
    per_host = outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    every = hosts.select("host").distinct().join(per_host, "host", "left")
    base = write_table(every.select(
        "host", registered_domain(F.col("host"), cfg).alias("domain"), host_suffix(F.col("host"), cfg).alias("suffix"),
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad")), "host-outcomes")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    root = base.agg(*sums).select(((F.coalesce("bad", F.lit(0)) + 1.0) / (F.coalesce("n", F.lit(0)) + 2.0)).alias("pmean"))
    suffixes = base.groupBy("suffix").agg(*sums).join(F.broadcast(root))
    suffixes = _shrink(suffixes, "suffix", None, cfg)
    domains = base.groupBy("suffix", "domain").agg(*sums)
    domains = domains.join(suffixes.select("suffix", F.col("mean").alias("pmean")), "suffix")
    domains = _shrink(domains, "domain", "suffix", cfg)
    hosts_ = base.join(domains.select("suffix", "domain", F.col("mean").alias("pmean")), ["suffix", "domain"])
    return _shrink(hosts_, "host", "domain", cfg).select("host", "n", "bad", "mean", "strength")


def posterior_bounds(mean: Column, strength: Column, z: float) -> tuple[Column, Column]:
    """``mean`` -/+ ``z`` standard deviations of the beta posterior, within 0..1."""
    sd = F.sqrt(mean * (1 - mean) / (strength + 1))
    return F.greatest(mean - z * sd, F.lit(0.0)), F.least(mean + z * sd, F.lit(1.0))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (),
                cfg: ReputationConfig = ReputationConfig(), id_col: str = "page_id", url_col: str = "url",
                label_id_col: str = "page_id") -> DataFrame:
    """Judge every page: ``id, host, path, rule, verdict, bad_rate, bad_low, bad_high``.

    ``labels``: ``label_id_col`` and ``bad`` (boolean). Labels of pages that a
    rule covers count as outcomes of their host like any other.
    """
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    p = p.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    lab = labels.select(F.col(label_id_col).alias("id"), F.col("bad").cast("int").alias("bad"))
    outcomes = p.select("id", "host").join(lab.where("id is not null and bad is not null"), "id").select("host", "bad")
    rep = write_table(host_reputation(outcomes, p.select("host"), cfg), "host-reputation")
    low, high = posterior_bounds(F.col("mean"), F.col("strength"), cfg.z)
    rep = rep.select("host", F.col("mean").alias("bad_rate"), low.alias("bad_low"), high.alias("bad_high"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    judged = p.withColumn("rule", rule).join(broadcast_if_small(rep), "host", "left")
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("rule") == r.name, F.lit(r.verdict)).otherwise(by_rule)
    by_host = F.when(F.col("bad_low") > cfg.max_bad_rate, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce(by_rule, by_host).alias("verdict"), "bad_rate", "bad_low", "bad_high")
