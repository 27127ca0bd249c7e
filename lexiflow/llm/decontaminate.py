"""Benchmark decontamination by SimHash over item-sized windows.

Texts and benchmark items are sequences of words (A-Z in lower case), their
features the hashes of five-word shingles (an item of fewer words is one shingle of
its own length). A window is as many words of a document as an item has; it is
placed wherever a shingle of the document is one of the item, so that the two
shingles lie on one another, and moved inwards at the ends of the document. Every
window gets a 64-bit SimHash weighted by how often each shingle occurs in it.
The fingerprints of items of the window's size are found by multi-index
Hamming search: eight blocks of eight bits, each block of an item entered with
all values within ``BLOCK_RADIUS`` bits, so that any two fingerprints at most
``RADIUS`` apart meet in some block. What is found is verified exactly: weighted
Jaccard similarity (smaller over larger number of occurrences, summed) of at least
``similarity``.

A window that shares no shingle with its item has similarity 0, so every passage
that comes near the similarity gets windows, one for each way its shingles lie on
the item's. At a similarity of 0.8 the expected distance of two fingerprints is
9.7 bits with a deviation of 2.9, and ``RADIUS`` is 4.5 deviations above it.

Scale: all of it is column expressions, explode and equi-joins. The benchmark's
shingles are broadcast while their measured size allows it, else shuffled. Only
documents with a hit are read again for their windows, and only windows with a
fingerprint match reach the exact comparison. A document's windows stay within
its own row until they are distinct (windows of equal shingles, as told by a 64-bit hash
of them, count once, so a text that repeats itself has few), so a passage that a third
of all documents share costs each of them a few rows, and no two documents are ever
compared. The index is probed with fingerprints alone; shingles are joined to what it
found.

Edge cases: null and empty texts and items have no words and match nothing; a
document shorter than an item is compared whole; repeated rows (equal id and
text) are reported once; an empty benchmark finds nothing; of several windows of a
document for an item the most similar one, then the first, is reported.
"""

from __future__ import annotations

import functools
import itertools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.util import let
from ..session import broadcast_if_small, write_table
from .common import SPACE, ascii_lower

BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1


@dataclass(frozen=True)
class LeakConfig:
    shingle: int = 5
    similarity: float = 0.8


def words_of(text: Column) -> Column:
    bare = F.btrim(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))


def shingles(word_hashes: Column, k: int) -> Column:
    """Hash of each run of ``k`` words, in order."""
    n = F.size(word_hashes)
    return F.transform(F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>")),
                       lambda i: F.xxhash64(F.lit(k), *[F.get(word_hashes, i + j) for j in range(k)]))


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """Add ``_h``: hashes of the words."""
    return df.withColumn("_w", words_of(F.col(text))).withColumn(
        "_h", F.transform("_w", lambda w: F.xxhash64(w))).drop("_w")


def simhash(sh: Column) -> Column:
    """64-bit fingerprint: a bit is set if more than half of the shingles (with
    repeats) have it. Two counters share a long, so there are 32 sums."""
    lanes = F.lit((1 << 32) | 1)
    sums = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.aggregate(
        sh, F.lit(0).cast("long"), lambda a, h: a + F.call_function("shiftrightunsigned", h, k).bitwiseAND(lanes)))

    def bits(s: Column) -> Column:
        n = F.size(sh)
        out = []
        for k in range(32):
            low = F.get(s, k).bitwiseAND(F.lit(0xFFFFFFFF))
            high = F.shiftrightunsigned(F.get(s, k), 32)
            for bit, count in ((k, low), (k + 32, high)):
                value = 1 << bit if bit < 63 else -(1 << 63)
                out.append(F.when(2 * count > n, F.lit(value)).otherwise(F.lit(0)).cast("long"))
        return functools.reduce(lambda a, b: a.bitwiseOR(b), out)

    return let(sums, bits)


def block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, BLOCK_BITS * b).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def block_masks() -> list[int]:
    """All changes of at most ``BLOCK_RADIUS`` bits of a block."""
    return [functools.reduce(operator.or_, (1 << i for i in c), 0)
            for r in range(BLOCK_RADIUS + 1) for c in itertools.combinations(range(BLOCK_BITS), r)]


def numbered(sh: Column) -> Column:
    """Shingles told apart by their occurrence number, so that multisets can be
    compared as sets. Equal shingles lie together in the sorted array, so each run
    of them is numbered on its own: the time is that of the sort."""
    first = F.transform(sh, lambda h: F.xxhash64(h, F.lit(0)))

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.flatten(F.transform(at, lambda p, j: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get(at, j + 1), F.size(s)) - p - 1), lambda k: F.xxhash64(F.get(s, p), k)))))

    return F.when(F.size(F.array_distinct(sh)) == F.size(sh), first).otherwise(let(F.sort_array(sh), runs))


def benchmark_items(benchmark: DataFrame, cfg: LeakConfig, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, size`` (words), ``sh`` (shingles), ``fp`` of items with words; stored."""
    src = _hashed(benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")), "text")
    h, n = F.col("_h"), F.size("_h")
    sh = F.when(n >= cfg.shingle, shingles(h, cfg.shingle))
    for k in range(1, cfg.shingle):
        sh = F.when(n == k, shingles(h, k)).otherwise(sh)
    items = src.where(n > 0).select("item_id", n.alias("size"), sh.alias("sh"))
    return write_table(items.withColumn("fp", simhash(F.col("sh"))), "items")


def _windows(docs: DataFrame, items: DataFrame, cfg: LeakConfig) -> DataFrame:
    """``doc_id, th, windows``: distinct (start, size) that share a shingle with
    an item of that size, aligned on it. ``docs``: doc_id, th, _h."""
    seeds = write_table(items.select("size", F.posexplode("sh").alias("at", "h")).distinct(), "item-shingles")
    short = [r[0] for r in items.where(F.col("size") < cfg.shingle).select("size").distinct().collect()]  # below 5
    parts = [F.transform(shingles(F.col("_h"), k), lambda h, i: F.struct(h.alias("h"), i.alias("pos")))
             for k in sorted([*short, cfg.shingle])]
    rows = docs.select("doc_id", "th", F.size("_h").alias("n"), F.explode(F.concat(*parts)).alias("s"))
    hit = rows.select("doc_id", "th", "n", F.col("s.h").alias("h"), F.col("s.pos").alias("pos")).join(
        broadcast_if_small(seeds), "h")
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("n") - F.col("size")))
    return hit.groupBy("doc_id", "th").agg(F.collect_set(F.struct(start.alias("start"), "size")).alias("windows"))


def _distinct_windows(h: Column, windows: Column, k: int) -> Column:
    """Windows of one document with their shingles; of windows of one size with equal
    shingles (a passage that repeats itself) the first alone."""
    n_words = lambda w: F.least(w["size"], F.size(h) - w["start"])

    def cut(s: Column) -> Column:
        def sh(w: Column) -> Column:
            out = F.slice(s, w["start"] + 1, F.greatest(n_words(w) - k + 1, F.lit(0)))
            for j in range(1, k):
                out = F.when(w["size"] == j, F.array(F.xxhash64(F.lit(j), *[F.get(h, w["start"] + i) for i in range(j)]))).otherwise(out)
            return out

        signed = F.transform(windows, lambda w: F.struct(
            F.xxhash64(w["size"], F.sort_array(sh(w))).alias("sig"), w["start"].alias("start"), w["size"].alias("size")))
        one = let(F.sort_array(signed), lambda a: F.filter(a, lambda w, i: (i == 0) | (w["sig"] != F.get(a, i - 1)["sig"])))
        return F.transform(one, lambda w: F.struct(
            w["start"].alias("start"), w["size"].alias("size"), n_words(w).alias("n_words"), sh(w).alias("sh")))

    return let(shingles(h, k), cut)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               cfg: LeakConfig = LeakConfig()) -> DataFrame:
    """``doc_id, th`` (a hash of the text, which tells rows of one id apart),
    ``item_id, start, n_words, similarity, hamming``: the best window of each document for
    each item that it holds."""
    items = benchmark_items(benchmark, cfg)
    text = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"),
                       F.col(text_col).alias("text"))
    hashed = _hashed(text, "text").drop("text")
    placed = write_table(_windows(hashed, items, cfg), "windows")
    # only documents with windows are read again
    keys = placed.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
    again = text.join(broadcast_if_small(keys), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")),
                      "left_semi")
    both = again.join(placed.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "windows"),
                      F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))).drop("_d", "_t")
    both = _hashed(both, "text").select("doc_id", "th", "_h", "windows")
    cut = both.select("doc_id", "th", F.explode(_distinct_windows(F.col("_h"), F.col("windows"), cfg.shingle)).alias("w"))
    windows = write_table(cut.select("doc_id", "th", "w.*").where(F.size("sh") > 0).withColumn(
        "fp", simhash(F.col("sh"))), "window-prints")
    # multi-index: eight probes per window, items entered with all near values of each block
    masks = F.array(*[F.lit(m) for m in block_masks()])

    def near_values(b: int) -> Column:
        return F.transform(masks, lambda m: F.struct(
            F.lit(b).alias("b"), block(F.col("fp"), b).bitwiseXOR(m).alias("v")))

    entries = F.flatten(F.array(*[near_values(b) for b in range(BLOCKS)]))
    index = items.select("item_id", "size", F.col("fp").alias("item_fp"), F.explode(entries).alias("e")).select(
        "item_id", "size", "item_fp", "e.b", "e.v")
    probes = windows.select("doc_id", "th", "start", "size", "n_words", "fp", F.explode(F.array(*[
        F.struct(F.lit(b).alias("b"), block(F.col("fp"), b).alias("v")) for b in range(BLOCKS)])).alias("p"))
    probes = probes.select("*", "p.b", "p.v").drop("p")
    near = probes.join(broadcast_if_small(write_table(index, "item-index")), ["size", "b", "v"])
    gap = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # a window meets an item in several blocks: the first block in which they are near counts
    first = functools.reduce(lambda x, b: F.when(
        F.bit_count(block(F.col("fp"), b).bitwiseXOR(block(F.col("item_fp"), b))) <= BLOCK_RADIUS, F.lit(b)).otherwise(x),
        reversed(range(BLOCKS)), F.lit(-1))
    near = near.where((gap <= RADIUS) & (F.col("b") == first)).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("start").alias("_at"), F.col("size").alias("_n"),
        "item_id", gap.alias("hamming")).distinct()
    # the shingles join only what the index found
    near = broadcast_if_small(write_table(near, "near"))
    exact = windows.select("doc_id", "th", "start", "size", "n_words", "sh").join(
        near, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))
        & (F.col("start") == F.col("_at")) & (F.col("size") == F.col("_n")))
    exact = exact.join(broadcast_if_small(items.select("item_id", F.col("size").alias("_size"), F.col("sh").alias("item_sh"))),
                       "item_id")
    exact = exact.select("doc_id", "th", "item_id", "start", "n_words", "hamming",
                         numbered(F.col("sh")).alias("a"), numbered(F.col("item_sh")).alias("z"))
    exact = exact.withColumn("both", F.size(F.array_intersect("a", "z")))
    exact = exact.withColumn("similarity", F.col("both").cast("double") / (F.size("a") + F.size("z") - F.col("both")))
    found = exact.where(F.col("similarity") >= cfg.similarity)
    best = found.groupBy("doc_id", "th", "item_id").agg(F.max(F.struct(
        "similarity", (-F.col("start")).alias("s"), "n_words", (-F.col("hamming")).alias("g"))).alias("m"))
    return best.select("doc_id", "th", "item_id", (-F.col("m.s")).cast("long").alias("start"),
                       F.col("m.n_words").cast("long").alias("n_words"), "m.similarity",
                       (-F.col("m.g")).cast("long").alias("hamming"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    cfg: LeakConfig = LeakConfig()) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they were."""
    leaks = write_table(find_leaks(docs, benchmark, id_col, text_col, cfg).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"))
    gone = broadcast_if_small(leaks)
    kept = rows.join(gone, F.col(f"row.{id_col}").eqNullSafe(F.col("_d"))
                     & (F.xxhash64(F.col(f"row.{text_col}")) == F.col("_t")), "left_anti")
    return kept.select("row.*")
