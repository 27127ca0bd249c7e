"""Language identification by Bayesian evidence fusion.

The posterior of a language is the product of

* the likelihood of the text under the language's trigram model (byte trigrams
  hashed to a fixed number of buckets, learned from labelled rows; tempered by
  1/3, since each byte is in three trigrams),
* the likelihood of the language declared in the markup, P(declared | language),
* the likelihood of the address suffix, P(suffix | language), and
* a prior of the host, smoothed hierarchically: host counts shrink to those of the
  registered domain, these to all rows.

The posterior weighs the labelled languages against each other only, and some language
is the best of them for any string. So a row is accepted only if, besides, its text is
likelier under the identified language than if all trigrams were equally likely: an
unknown script, random letters or a language far from the labelled ones fall short of
that, whatever the host or the markup says.

The counts behind the last three are grouped aggregations over all rows of the
language that the text alone gives. A row's own vote is taken out of every
count that judges it, so that no evidence counts itself.

Scale: learning and scoring are narrow jobs; a learning task holds the counts of at most
``BLOCK_LANGUAGES`` languages and sends them on when another comes. The trigram tables
go to the workers in blocks of as many languages, each of a fixed size
(``BLOCK_LANGUAGES`` x ``BUCKETS`` numbers at most), so there is no bound on the number
of languages. Labels and declared languages are primary subtags in lower case (``en``, ``EN``
and ``en-US`` are one); what is not one to eight letters labels nothing. Count tables have a row per host, suffix or
declared language and are joined as a broadcast while their measured size
allows it, else shuffled (AQE splits hot hosts).

Edge cases: a text without letters (null and empty included) has no text
evidence, casts no vote and is not accepted; null declared language, host or
suffix is no evidence of that kind; without any labelled row every row has a
null language and is not accepted. Of equally likely languages the first by name is
taken. Repeated rows are judged alike, and each counts as evidence.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, write_table
from .common import ascii_lower, bounded_batches
from .url_reputation import ReputationConfig, host_suffix, registered_domain, url_host

BUCKETS = 1 << 15
BLOCK_LANGUAGES = 128
LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class FusionConfig:
    temper: float = 1 / 3
    #: added to each trigram count
    smoothing: float = 0.5
    #: pseudo-rows that a level of the host hierarchy takes from its parent
    host_strength: float = 10.0
    #: pseudo-rows of the declared language and the suffix
    evidence_strength: float = 10.0
    #: accepted languages have at least this posterior
    min_posterior: float = 0.5


# ------------------------------------------------------------------ trigrams


CHUNK = 1 << 20  # bytes of text at a time


def trigram_chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket of every trigram of lower-case ASCII letters, bytes above 127 and
    blanks (for anything else; blanks around the text, no trigram of blanks
    only), and the number of the text that each belongs to. Texts come in
    slices of ``CHUNK`` bytes that overlap by two, so no trigram is lost or
    counted twice."""
    parts, owner, size = [], [], 0
    for i, t in enumerate(texts):
        p = b" " + t.lower().translate(LETTERS) + b" "
        for s in range(0, max(1, len(p) - 2), CHUNK):
            part = p[s:s + CHUNK + 2]
            parts.append(part)
            owner.append(i)
            size += len(part)
            if size >= CHUNK:
                yield _buckets(parts, owner)
                parts, owner, size = [], [], 0
    if parts:
        yield _buckets(parts, owner)


def _buckets(parts: list[bytes], owner: list[int]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    a = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    part = np.repeat(np.arange(len(parts)), lens)
    ok = (part[:-2] == part[2:]) & (code != 0x202020)
    bucket = (code[ok] * np.uint32(2654435761)) >> np.uint32(32 - 15)
    return bucket.astype(np.int64), np.array(owner, np.int64)[part[:-2][ok]]


_TAGS = re.compile(r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>")


def visible_text(page: str | None) -> str:
    """The text of an HTML page without scripts, styles, comments and tags."""
    return html.unescape(_TAGS.sub(" ", page or ""))


def primary_subtag(tag: Column) -> Column:
    """``en`` of ``en``, ``EN`` or ``en-US``; null if there is none."""
    got = ascii_lower(F.regexp_extract(tag.cast("string"), r"^\s*([A-Za-z]{1,8})(?![A-Za-z0-9])", 1))
    return F.when(got != "", got)


def learn(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, bucket, n`` over all labelled rows."""
    bounded_batches(labelled.sparkSession)

    def partial(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for x, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())],
                ["lang", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_pylist()
            texts = [t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()]
            names = sorted(set(langs))
            for start in range(0, len(names), BLOCK_LANGUAGES):
                some = {x: i for i, x in enumerate(names[start:start + BLOCK_LANGUAGES])}
                if len(counts.keys() | some.keys()) > BLOCK_LANGUAGES:
                    yield from partial(counts)
                    counts = {}
                of = np.array([some[x] for x in langs if x in some], np.int64)
                for bucket, which in trigram_chunks([t for t, x in zip(texts, langs) if x in some]):
                    flat = np.bincount(of[which] * BUCKETS + bucket, minlength=len(some) * BUCKETS)
                    for x, i in some.items():
                        counts[x] = counts.get(x, 0) + flat[i * BUCKETS:(i + 1) * BUCKETS]
        yield from partial(counts)

    rows = labelled.select(F.col(text_col).alias("text"), primary_subtag(F.col(lang_col)).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull())
    return rows.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def trigram_blocks(counts: DataFrame, cfg: FusionConfig) -> Iterator[tuple[list[str], np.ndarray]]:
    """Languages, ``BLOCK_LANGUAGES`` at a time in the order of their names, and log
    P(bucket | language), bucket by language. One block is fetched at a time."""
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    for start in range(0, len(langs), BLOCK_LANGUAGES):
        some = langs[start:start + BLOCK_LANGUAGES]
        got = counts.where(F.col("lang").between(some[0], some[-1])).toArrow().to_pandas()
        table = np.full((BUCKETS, len(some)), cfg.smoothing)
        at = np.searchsorted(np.array(some, object), got["lang"].to_numpy())
        table[got["bucket"].to_numpy(), at] += got["n"].to_numpy()
        yield some, np.log(table / table.sum(axis=0))


def all_scores(df: DataFrame, text_col: str, counts: DataFrame, cfg: FusionConfig,
               is_html: bool = False) -> tuple[DataFrame, list[str]]:
    """``df`` with ``_text`` (as ``text_scores`` gives it) over all languages of ``counts``,
    and these languages."""
    langs, parts = [], []
    for some, table in trigram_blocks(counts, cfg):
        parts.append(f"_text_{len(parts)}")
        df = text_scores(df, text_col, some, table, is_html, parts[-1])
        langs += some
    if not parts:
        return text_scores(df, text_col, [], np.zeros((BUCKETS, 0)), is_html), langs
    both = F.struct(F.col(f"{parts[0]}.n").alias("n"), F.concat(*[F.col(f"{p}.ll") for p in parts]).alias("ll"))
    return df.withColumn("_text", both).drop(*parts), langs


def text_scores(df: DataFrame, text_col: str, langs: list[str], table: np.ndarray, is_html: bool = False,
                out: str = "_text") -> DataFrame:
    """Add ``out``: struct of ``n`` (trigrams) and ``ll`` (log-likelihood by language)."""
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(table)
    n_langs = len(langs)

    @F.pandas_udf("n bigint, ll array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        columns = np.ascontiguousarray(shared.value.T)
        for s in batches:
            texts = [visible_text(t).encode("utf-8", "replace") if is_html else (t or "").encode("utf-8") for t in s]
            n, ll = np.zeros(len(texts), np.int64), np.zeros((len(texts), n_langs))
            for bucket, which in trigram_chunks(texts):
                if len(bucket):
                    first = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
                    n[which[first]] += np.diff(np.r_[first, len(bucket)])
                    for i in range(n_langs):
                        ll[which[first], i] += np.add.reduceat(columns[i][bucket], first)
            yield pd.DataFrame({"n": n, "ll": list(ll)})

    # as "nondeterministic", a filter on the result does not score every text a second time
    return df.withColumn(out, score.asNondeterministic()(F.col(text_col)))


# ------------------------------------------------------------------ evidence


def declared_language(page: Column) -> Column:
    """The primary subtag of the ``lang`` attribute of the html element, else null."""
    got = F.lower(F.regexp_extract(page, "(?is)<html\\b[^>]*?\\slang\\s*=\\s*[\"']?([a-z]+)", 1))
    return F.when(got != "", got)


def _votes(rows: DataFrame, key: str, n_langs: int) -> DataFrame:
    """``key, c``: rows by text language, over all rows with a vote."""
    sums = [F.count(F.when(F.col("vote") == i, 1)) for i in range(n_langs)]
    return rows.where(F.col(key).isNotNull() & F.col("vote").isNotNull()).groupBy(key).agg(F.array(*sums).alias("c"))


def fuse(rows: DataFrame, evidence: DataFrame, langs: list[str], cfg: FusionConfig) -> DataFrame:
    """``rows`` with ``declared, host, domain, suffix, n, ll`` and any other
    columns; adds ``text_lang, lang, posterior, accepted``. ``evidence``: the same
    rows in a stored table, of which the counts are taken."""
    L = len(langs)
    if not L:
        none = F.lit(None).cast("string")
        return rows.select("*", none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("posterior"),
                           F.lit(False).alias("accepted"))
    best = F.array_position(F.col("ll"), F.array_max("ll")) - 1
    vote = F.when(F.col("n") > 0, best)
    rows, evidence = rows.withColumn("vote", vote), evidence.withColumn("vote", vote)
    zeros = F.array(*[F.lit(0).cast("long")] * L)
    out = rows
    names = {"host": "hc", "domain": "dc", "suffix": "sc", "declared": "lc"}
    for key, c in names.items():
        votes = write_table(_votes(evidence, key, L), f"votes-{key}").withColumnsRenamed({key: f"_{key}", "c": c})
        out = out.join(broadcast_if_small(votes), F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
    total = evidence.where(F.col("vote").isNotNull()).agg(
        F.array(*[F.count(F.when(F.col("vote") == i, 1)) for i in range(L)]).alias("gc"))
    out = out.join(F.broadcast(total))  # one row

    def others(c: str) -> Column:  # the counts without the row's own vote
        seen = F.col(c).isNotNull()
        return F.transform(F.coalesce(F.col(c), zeros), lambda x, i: (
            x - F.when(seen & (F.col("vote") == i), 1).otherwise(0)).cast("double"))

    def total_of(c: str) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda x, y: x + y)

    tables = [*names.values(), "gc"]
    out = out.withColumns({c: others(c) for c in tables})
    out = out.withColumns({f"{c}_n": total_of(c) for c in tables})
    m, e, n = F.lit(cfg.host_strength), F.lit(cfg.evidence_strength), F.col("gc_n")
    out = out.withColumn("_p", F.transform("gc", lambda x: (x + 1) / (n + L)))
    for c in ("dc", "hc"):  # each level shrinks to the one above
        size = F.col(f"{c}_n")
        out = out.withColumn("_p", F.zip_with(c, "_p", lambda x, p: (x + m * p) / (size + m)))
    out = out.withColumn("_s", F.zip_with("ll", "_p", lambda x, p: x * cfg.temper + F.log(p)))
    for key, c in (("declared", "lc"), ("suffix", "sc")):
        # P(value | language), shrunk to the value's share of all rows
        share = (F.col(f"{c}_n") + 1) / (n + 2)
        given = F.zip_with(c, "gc", lambda x, g: F.log((x + e * share) / (g + e)))
        out = out.withColumn("_s", F.when(F.col(key).isNotNull(), F.zip_with("_s", given, lambda x, y: x + y)).otherwise(F.col("_s")))
    top = F.array_max("_s")
    mass = F.aggregate(F.transform("_s", lambda s: F.exp(s - top)), F.lit(0.0), lambda a, x: a + x)
    names_ = F.array(*[F.lit(x) for x in langs])
    out = out.select("*", F.get(names_, F.col("vote").cast("int")).alias("text_lang"),
                     F.get(names_, (F.array_position("_s", top) - 1).cast("int")).alias("lang"),
                     (1 / mass).alias("posterior"))
    # against the model in which every trigram is as likely as any other
    likely = F.get("ll", (F.array_position("_s", top) - 1).cast("int")) > F.col("n") * F.lit(-math.log(BUCKETS))
    ok = (F.col("n") > 0) & (F.col("posterior") >= cfg.min_posterior) & likely
    return out.withColumn("accepted", ok).drop("_s", "_p", "vote", *tables, *[f"{c}_n" for c in tables])


def identify_pages(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", label_text_col: str = "text", label_col: str = "lang",
                   cfg: FusionConfig = FusionConfig()) -> DataFrame:
    """Per page: ``id, host, declared, suffix, n_trigrams, text_lang, lang,
    posterior, accepted``. ``labelled``: texts with their language."""
    counts = write_table(learn(labelled, label_text_col, label_col), "trigrams")
    host = F.when(url_host(F.col("url")) != "", url_host(F.col("url")))
    rep = ReputationConfig()
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    src, langs = all_scores(src, "html", counts, cfg, is_html=True)
    src = src.select("id", declared_language(F.col("html")).alias("declared"), host.alias("host"), "_text")
    src = src.select("id", "declared", "host", registered_domain(F.col("host"), rep).alias("domain"),
                     host_suffix(F.col("host"), rep).alias("suffix"), "_text.n", "_text.ll")
    stored = write_table(src, "evidence")
    out = fuse(stored, stored, langs, cfg)
    return out.select(F.col("id").alias(id_col), "host", "declared", "suffix", F.col("n").alias("n_trigrams"),
                      "text_lang", "lang", "posterior", "accepted")


def identify_documents(docs: DataFrame, text_col: str = "text", declared_col: str = "lang", host_col: str = "source",
                       cfg: FusionConfig = FusionConfig()) -> DataFrame:
    """``row`` (all columns of ``docs`` in a struct) with ``text_lang, lang,
    posterior, accepted``. Documents have no address: their source is the host,
    and their declared language also labels the texts that the models learn from."""
    counts = write_table(learn(docs, text_col, declared_col), "trigrams")
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col(f"row.{text_col}").alias("text"),
                       primary_subtag(F.col(f"row.{declared_col}")).alias("declared"),
                       F.col(f"row.{host_col}").cast("string").alias("host"))
    scored, langs = all_scores(rows, "text", counts, cfg)
    none = F.lit(None).cast("string")
    scored = scored.select("row", "declared", "host", F.col("host").alias("domain"), none.alias("suffix"), "_text.n", "_text.ll")
    # texts are scored again for the result instead of stored beside the evidence
    evidence = write_table(scored.drop("row"), "evidence")
    return fuse(scored, evidence, langs, cfg).select("row", "text_lang", "lang", "posterior", "accepted")
