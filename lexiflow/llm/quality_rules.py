"""Quality rules with risk-controlled thresholds.

Every rule compares a ratio of a text with a cutoff. The cutoffs are not chosen by
hand: on a labelled holdout, the good documents that a cutoff would reject are
counted per stratum, and a cutoff is taken only if an exact binomial test rejects
"the false rejection rate is above the limit" there. Each (stratum, rule) walks
its cutoffs from lenient to strict and stops at the first that fails
(fixed-sequence testing, which needs no correction within the walk); the level is
divided by the number of (stratum, rule) walks (Bonferroni). So with
probability 1 - ``delta`` all strata at once lose at most ``max_false_rejection``
of their good documents to the rules together (each rule gets an equal share of
that limit).

The p-value is the lower binomial tail P(X <= k), X ~ Bin(n, limit), summed
downwards from k: exact for the first ``TAIL`` terms, and what is left is
bounded from above by a geometric series, so that no cutoff passes wrongly.

Scale: features are column expressions of one row (no shuffle, no Python).
The holdout join shuffles a few numbers per document; counts per stratum are one
partial aggregate. The threshold table has a row per stratum and is broadcast
while its measured size is within ``broadcast_if_small``.

Edge cases: a null text has no words and fails the base rule; a ratio with an
empty denominator never exceeds a cutoff; null strata form a stratum of
their own; several labels of a document count as good only if all are; a
stratum with too few good documents to certify any cutoff rejects nothing by
rule; without labels only the base rule holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.util import let
from ..session import broadcast_if_small, write_table
from .common import SPACE
from .sharding import log_choose

TAIL = 1000
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
SHARES = (500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20, 10, 5)


@dataclass(frozen=True)
class Rule:
    """Reject when 1000 * ``over`` > cutoff * ``under``; cutoffs from lenient to strict."""
    name: str
    over: str
    under: str
    cutoffs: Sequence[int]


RULES = (
    Rule("symbols", "n_symbols", "word_chars", SHARES),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", (900, 800, 700, 600, *SHARES)),
    Rule("repeated_words", "n_repeat_words", "n_words", (900, 800, 700, 600, *SHARES)),
    Rule("upper_case", "n_upper", "word_chars", (900, 800, 700, 600, *SHARES)),
    Rule("long_words", "word_chars", "n_words", (30000, 25000, 20000, 18000, 16000, 14000, 12000, 11000, 10000)),
)


@dataclass(frozen=True)
class RiskConfig:
    max_false_rejection: float = 0.02
    delta: float = 0.05
    min_words: int = 50
    max_repeat_percent: int = 50


# ------------------------------------------------------------------ features


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words covered by 3-word windows found twice or more. ``hashes`` has a
    64-bit hash per window; two different windows of one text share one with
    a probability below 1e-10 even at 20,000 words."""
    def covered(pos: Column) -> Column:
        gaps = F.transform(pos, lambda p, j: F.when(j == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), p - F.get(pos, j - 1))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]))
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    count = let(let(by_hash, repeated), covered)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(count)


def with_features(df: DataFrame, text_col: str = "text", out: str = "_f") -> DataFrame:
    """Add ``out``: a struct of ``FEATURES`` (long), from the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    a = df.select("*", words.alias("_words"), lines.alias("_lines"))
    w, n = F.col("_words"), F.size("_words")
    windows = F.transform(F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    b = a.select("*", windows.alias("_hashes"))
    kept = lambda pattern: F.octet_length(F.regexp_replace(text, pattern, ""))
    values = {
        "n_words": n, "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": kept("[^#*$%&|<>]+"), "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _repeat_words(w, F.col("_hashes")), "n_lines": F.size("_lines"), "n_upper": kept("[^A-Z]+"),
    }
    # exploding one struct keeps the optimizer from copying these expressions into every later use of a field
    one = F.array(F.struct(*[values[f].cast("long").alias(f) for f in FEATURES]))
    return b.select(*df.columns, F.explode(one).alias(out))


def base_failed(f: Column, cfg: RiskConfig) -> Column:
    return (f["n_words"] < cfg.min_words) | (100 * f["n_repeat_words"] > cfg.max_repeat_percent * f["n_words"])


# ------------------------------------------------------------------ thresholds


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """Upper bound of P(X <= k) for X ~ Bin(n, rate); exact while k <= ``TAIL``.
    1 at or above the mean, where no test passes."""
    odds = (1 - rate) / rate

    def tail(p: Column) -> Column:
        k_, n_ = p["k"].cast("double"), p["n"].cast("double")
        top = F.exp(log_choose(p["n"], p["k"]) + k_ * math.log(rate) + (n_ - k_) * math.log1p(-rate))
        zero = F.struct(top.alias("t"), top.alias("s"))

        def step(acc: Column, i: Column) -> Column:
            t = acc["t"] * (k_ - i + 1) / (n_ - k_ + i) * odds
            return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

        steps = F.least(p["k"], F.lit(TAIL).cast("long"))
        end = F.aggregate(F.when(steps > 0, F.sequence(F.lit(1).cast("long"), steps)).otherwise(
            F.array().cast("array<bigint>")), zero, step)
        ratio = (k_ - steps) / (n_ - k_ + steps + 1) * odds
        return let(end, lambda e: e["s"] + F.when(p["k"] > steps, e["t"] * ratio / (1 - ratio)).otherwise(0.0))

    return F.when((n <= 0) | (k.cast("double") >= n.cast("double") * rate), F.lit(1.0)).otherwise(
        let(F.struct(k.cast("long").alias("k"), n.cast("long").alias("n")), tail))


def rejects(f: Column, rule: Rule, cutoff: Column) -> Column:
    return 1000 * f[rule.over] > cutoff * f[rule.under]


def good_documents(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """Ids all of whose labels are good."""
    seen = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
    return seen.groupBy(F.col(id_col).alias("id")).agg(F.min(quality_col).alias("q")).where("q = 1").select("id")


def thresholds(features: DataFrame, good_ids: DataFrame, cfg: RiskConfig = RiskConfig(),
               rules: Sequence[Rule] = RULES) -> DataFrame:
    """``stratum, n_good, cutoffs``: the certified cutoff of each rule (null: none).

    ``features``: ``id``, ``stratum`` and ``f`` (the feature struct)."""
    held = features.join(good_ids, "id")
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.array(*[
        F.array(*[F.count(F.when(rejects(F.col("f"), r, F.lit(c)), 1)) for c in r.cutoffs]) for r in rules]).alias("k"))
    counts = write_table(counts, "holdout-counts")
    walks = counts.count() * len(rules)
    if not walks:
        return counts.select("stratum", F.col("n").alias("n_good"), F.array().cast("array<int>").alias("cutoffs"))
    limit, level = cfg.max_false_rejection / len(rules), cfg.delta / walks

    def passed(i: int) -> Column:
        # cutoffs before the first failure
        tests = F.transform(F.get("k", i), lambda k: binomial_tail(k, F.col("n"), limit) <= level)
        return F.aggregate(tests, F.struct(F.lit(0).alias("m"), F.lit(True).alias("go")), lambda a, t: F.struct(
            (a["m"] + F.when(a["go"] & t, 1).otherwise(0)).alias("m"), (a["go"] & t).alias("go")))["m"]

    cut = [F.get(F.array(*[F.lit(c) for c in r.cutoffs]), passed(i) - 1) for i, r in enumerate(rules)]
    return counts.select("stratum", F.col("n").alias("n_good"), F.array(*cut).alias("cutoffs"))


def with_verdict(df: DataFrame, table: DataFrame, stratum: Column, f: str = "_f", cfg: RiskConfig = RiskConfig(),
                 rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``base_failed``, ``failed_rules`` (names) and ``kept`` in the column
    ``_v``, a struct. ``table``: from ``thresholds``, stored."""
    cuts = broadcast_if_small(table.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs")))
    j = df.join(cuts, stratum == F.col("_stratum"), "left")
    failed = F.array_compact(F.array(*[
        F.when(rejects(F.col(f), r, F.get("_cutoffs", i)), F.lit(r.name)) for i, r in enumerate(rules)]))
    base = base_failed(F.col(f), cfg)
    v = F.struct(base.alias("base_failed"), failed.alias("failed_rules"), (~base & (F.size(failed) == 0)).alias("kept"))
    return j.select(*df.columns, v.alias("_v"))


def stratum_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def judge_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    stratum_col: str = "lang", cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """One row per document: ``id``, the features, ``base_failed``,
    ``failed_rules`` and ``kept``."""
    src = docs.select(F.col(id_col).alias("id"), stratum_of(F.col(stratum_col)).alias("stratum"),
                      F.col(text_col).alias("text"))
    feats = write_table(with_features(src, "text", "f").select("id", "stratum", "f"), "features")
    table = write_table(thresholds(feats, good_documents(labels), cfg), "thresholds")
    out = with_verdict(feats, table, F.col("stratum"), "f", cfg)
    return out.select(F.col("id").alias(id_col), "f.*", "_v.base_failed", "_v.failed_rules", "_v.kept")


def keep_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   stratum_col: str = "lang", cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, all columns as they were.

    Features are computed twice (once for the thresholds, once for the filter)
    rather than joined back, which would shuffle the texts."""
    src = docs.select(F.col(id_col).alias("id"), stratum_of(F.col(stratum_col)).alias("stratum"),
                      F.col(text_col).alias("text"))
    feats = with_features(src, "text", "f").select("id", "stratum", "f")
    table = write_table(thresholds(feats, good_documents(labels), cfg), "thresholds")
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col(f"row.{text_col}").alias("text"),
                       stratum_of(F.col(f"row.{stratum_col}")).alias("stratum"))
    rows = with_features(rows, "text", "f").select("row", "stratum", "f")
    return with_verdict(rows, table, F.col("stratum"), "f", cfg).where("_v.kept").select("row.*")
