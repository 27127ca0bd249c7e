"""Language-model scoring from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale and only the
levels are kept: an n-gram of level q is entered q times, as (n-gram, 1) to
(n-gram, q). A count is read back by probing levels 1, 2, ... until one is
missing, so frequent n-grams cost more probes than rare ones and nothing but a bit
array goes to the workers. A false positive (about ``2 ** -HASHES`` per level)
can only raise a count, and a pair is never taken to be more frequent than its
words.

Scores are interpolated: p(w | u) = weight * c(uw) / c(u) + (1 - weight) * p(w),
p(w) = (c(w) + 1) / (N + V + 1), with the counts that the filter gives.

Scale: a learning task sends each n-gram it has seen (a 64-bit hash) with its
count; one shuffle sums them. The filter is built by segment: each n-gram lies
in one segment of ``SEGMENT_BITS`` bits, and n-grams are stored by hash range, so
a task builds few segments and only finished ones leave it. The filter grows with
the number of distinct n-grams, so the rate of false positives is the same at any
size. Up to ``max_filter_bytes`` it is broadcast. A larger one is never in one
place: the distinct words and pairs of the texts are dealt, with the segments, by
slices of ``SLICE_SEGMENTS`` segments, a task probes one slice at a time, and the
texts' pairs are joined with what their probes gave. Both ways give the same
levels. Exact word counts (for the base score) of the ``head_words`` most frequent
words, or fewer, go to the workers as arrays; tokens of rarer words are joined by a
shuffle.

Edge cases: a null or empty text is the end token alone; a null id is learned
from; repeated rows count again; if nothing is learned from, N = V = 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, shuffle_partitions, write_table
from .common import bounded_batches, row_ids

SEGMENT_BITS = 1 << 16
SEGMENT_BYTES = SEGMENT_BITS // 8
SLICE_SEGMENTS = 64
HASHES = 4
END = b"\n"  # not a word, since words hold no white space
CACHE_WORDS = 400_000
FLUSH_PAIRS = 4 << 20
PROBES = 1 << 17  # probes of a slice at a time


@dataclass(frozen=True)
class LmConfig:
    #: ratio of neighbouring levels
    base: float = 1.5
    weight: float = 0.7
    #: the largest filter that is broadcast; a larger one is probed in slices
    max_filter_bytes: int = 128 << 20
    head_words: int = 1 << 20

    def thresholds(self) -> np.ndarray:
        """Smallest count of each level (1, 2, 3, 4, 6, ... for base 1.5)."""
        out = [1]
        while out[-1] < 1 << 60:
            out.append(max(out[-1] + 1, int(np.ceil(self.base ** len(out)))))
        return np.array(out, np.int64)


# ------------------------------------------------------------------ hashing and probes


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (a bijection of 64-bit numbers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first + np.uint64(0x9E3779B97F4A7C15)) + second)


def word_hashes(words: list[bytes], cache: dict[bytes, int]) -> np.ndarray:
    if len(cache) > CACHE_WORDS:
        cache.clear()
    new = set(words).difference(cache)
    cache.update(zip(new, map(xxhash.xxh64_intdigest, new)))
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def segments(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def bit_positions(h: np.ndarray, level: int) -> list[np.ndarray]:
    """``HASHES`` bits within the segment for each n-gram at ``level``."""
    x = mix(h + np.uint64(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    return [((x >> np.uint64(16 * i)) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64) for i in range(HASHES)]


def build_segments(h: np.ndarray, level: np.ndarray, seg: np.ndarray, bits: dict[int, np.ndarray]) -> None:
    """Enter n-grams at levels 1 to ``level`` into ``bits`` (an array of booleans by segment)."""
    order = np.argsort(seg, kind="stable")
    h, level, seg = h[order], level[order], seg[order]
    cut = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]]) if len(seg) else []
    for a, z in zip(cut, np.r_[cut[1:], len(seg)] if len(seg) else []):
        b = bits.setdefault(int(seg[a]), np.zeros(SEGMENT_BITS, bool))
        hs, ls = h[a:z], level[a:z]
        for q in range(1, int(ls.max()) + 1):
            for at in bit_positions(hs[ls >= q], q):
                b[at] = True


def probe(h: np.ndarray, bits: np.ndarray, n_segments: int, first: int = 0, most: int = len(LmConfig().thresholds())) -> np.ndarray:
    """Level of each n-gram (0: not there), ``most`` at most. ``bits`` begins with segment ``first``."""
    out = np.zeros(len(h), np.int64)
    if not n_segments:
        return out
    alive, base = np.arange(len(h)), (segments(h, n_segments) - first) * SEGMENT_BYTES
    level = 0
    while len(alive) and level < most:
        level += 1
        hit = np.ones(len(alive), bool)
        for at in bit_positions(h[alive], level):
            hit &= (bits[base[alive] + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
        alive = alive[hit]
        out[alive] = level
    return out


def decode(level: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The middle of the level's counts."""
    low = thresholds[np.minimum(np.maximum(level, 1), len(thresholds)) - 1]
    high = thresholds[np.minimum(np.maximum(level, 1), len(thresholds) - 1)] - 1
    return np.where(level > 0, (low + np.maximum(high, low)) / 2, 0.0)


# ------------------------------------------------------------------ learning


def token_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words (A-Z in lower case) and an end token per text: the hash of each distinct token,
    the end token last, the number there of every token, and the length of each text in tokens.
    Arrow cuts and numbers the words, so only the distinct ones become Python objects."""
    split = compute.ascii_split_whitespace(compute.ascii_lower(compute.fill_null(texts, "")))
    flat = split.flatten().dictionary_encode()
    words, ids = flat.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), flat.indices.to_numpy()
    lens = np.diff(split.offsets.to_numpy()).astype(np.int64)
    # white space at either end leaves empty strings, which are no words
    empty = np.flatnonzero(compute.binary_length(flat.dictionary).to_numpy() == 0)
    if len(empty):
        word = ids != empty[0]
        lens -= np.bincount(np.repeat(np.arange(len(lens)), lens)[~word], minlength=len(lens))
        ids = ids[word]
    lens += 1
    out = np.full(int(lens.sum()), len(words), np.int64)
    word = np.ones(len(out), bool)
    word[np.cumsum(lens) - 1] = False
    out[word] = ids
    words.append(END)
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), out, lens


def pairs_of(h: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Hash of (token before, token); before the first token stands an end token."""
    end = np.uint64(xxhash.xxh64_intdigest(END))
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.cumsum(lens) - lens] = end
    return pair_hash(before, h)


def count_ngrams(train: DataFrame) -> DataFrame:
    """``pair, h, n``: count of every word (``pair`` false) and pair over all rows of
    ``train`` (text), by 64-bit hash; stored, the n-grams of one of 4096 ranges of hashes in one file."""
    spark = train.sparkSession
    bounded_batches(spark)

    def emit(pair: bool, h: np.ndarray, n: np.ndarray):
        for i in range(0, len(h), 200_000):
            part = h[i:i + 200_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), pair)), pa.array(part.view(np.int64)), pa.array(n[i:i + 200_000])], ["pair", "h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[np.ndarray] = []  # since the last flush: words of each batch, and how often
        times: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size = 0

        def flush():
            if held:
                h, at = np.unique(np.concatenate(words), return_inverse=True)
                n = np.zeros(len(h), np.int64)
                np.add.at(n, at, np.concatenate(times))
                yield from emit(False, h, n)
                yield from emit(True, *np.unique(np.concatenate(held), return_counts=True))

        for b in batches:
            h, ids, lens = token_ids(b.column(0))
            n = np.bincount(ids, minlength=len(h))
            words.append(h[n > 0])
            times.append(n[n > 0])
            held.append(pairs_of(h[ids], lens))
            size += len(ids)
            if size > FLUSH_PAIRS:
                yield from flush()
                words, times, held, size = [], [], [], 0
        yield from flush()

    # the range of the hash decides the partition, so a task of the filter meets few segments
    rows = train.mapInArrow(run, "pair boolean, h bigint, n bigint").withColumn("r", F.shiftrightunsigned("h", 52))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.repartition(parts, "r").groupBy("r", "pair", "h").agg(F.sum("n").alias("n"))
    return write_table(total.select("pair", "h", "n"), "ngrams")


def filter_segments(entries: int) -> int:
    """Segments of a filter that ``entries`` entries fill to one half."""
    return int(np.ceil(entries * HASHES / np.log(2) / SEGMENT_BITS))


def filter_parts(ngrams: DataFrame, n: int, cfg: LmConfig) -> DataFrame:
    """``seg, bits``: the filter of ``n`` segments for ``ngrams`` (h, n; stored). A segment
    may come in several rows, which are to be united."""
    th = cfg.thresholds()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        held, size = [], 0

        def enter():
            t = pa.Table.from_batches(held)
            h = t.column(0).to_numpy().view(np.uint64)
            level, seg = np.searchsorted(th, t.column(1).to_numpy(), "right"), segments(h, n)
            order = np.argsort(seg, kind="stable")
            h, level, seg = h[order], level[order], seg[order]
            cut = np.r_[0, np.flatnonzero(np.diff(seg // SLICE_SEGMENTS)) + 1, len(seg)]
            for a, z in zip(cut[:-1], cut[1:]):  # a slice at a time is unpacked
                part: dict[int, np.ndarray] = {}
                build_segments(h[a:z], level[a:z], seg[a:z], part)
                for k, x in part.items():
                    x = np.packbits(x, bitorder="little")
                    bits[k] = bits[k] | x if k in bits else x

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size > 1 << 20:
                enter()
                held, size = [], 0
        if size:
            enter()
        keys = sorted(bits)
        for i in range(0, len(keys), 200):
            part = keys[i:i + 200]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array([bits[k].tobytes() for k in part], pa.binary())], ["seg", "bits"])

    return ngrams.select("h", "n").mapInArrow(run, "seg bigint, bits binary")


def build_filter(ngrams: DataFrame, n: int, cfg: LmConfig) -> np.ndarray:
    """Bits of the filter of ``n`` segments for ``ngrams`` (h, n; stored)."""
    out = np.zeros(n * SEGMENT_BYTES, np.uint8)
    if n:
        got = filter_parts(ngrams, n, cfg).toArrow()
        for seg, bits in zip(got.column("seg").to_pylist(), got.column("bits")):
            at = seg * SEGMENT_BYTES
            out[at:at + SEGMENT_BYTES] |= np.frombuffer(bits.as_buffer(), np.uint8)
    return out


def probe_slices(parts: DataFrame, probes: DataFrame, n: int, cfg: LmConfig) -> DataFrame:
    """``pair, h, level`` for ``probes`` (pair, h; distinct) in the filter of ``n`` segments
    that ``parts`` make up. Hashes are even, so are the slices."""
    most = len(cfg.thresholds())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, now = np.zeros(SLICE_SEGMENTS * SEGMENT_BYTES, np.uint8), None
        held, size = [], 0

        def answer():
            t = pa.Table.from_batches(held).combine_chunks()
            h = t.column("h").to_numpy()
            level = probe(h.view(np.uint64), bits, n, now * SLICE_SEGMENTS, most)
            for i in range(0, len(h), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [t.column("pair").slice(i, 100_000).combine_chunks(), pa.array(h[i:i + 100_000]),
                     pa.array(level[i:i + 100_000].astype(np.int32))], ["pair", "h", "level"])

        for b in batches:  # by slice, in each slice the segments before the probes
            of, ask = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
            cut = np.r_[0, np.flatnonzero((of[1:] != of[:-1]) | (ask[1:] != ask[:-1])) + 1, len(of)]
            for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if a == z:
                    continue
                if of[a] != now:
                    if held:
                        yield from answer()
                        held, size = [], 0
                    now = int(of[a])
                    bits[:] = 0
                part = b.slice(a, z - a)
                if ask[a]:
                    held.append(part.select(["pair", "h"]))
                    size += z - a
                    if size >= PROBES:
                        yield from answer()
                        held, size = [], 0
                else:
                    for seg, x in zip(part.column("seg").to_pylist(), part.column("bits")):
                        at = (seg - now * SLICE_SEGMENTS) * SEGMENT_BYTES
                        bits[at:at + SEGMENT_BYTES] |= np.frombuffer(x.as_buffer(), np.uint8)
        if held:
            yield from answer()

    seg = F.shiftrightunsigned(F.shiftrightunsigned("h", 32) * F.lit(n).cast("long"), 32)
    rows = parts.select(F.floor(F.col("seg") / SLICE_SEGMENTS).alias("slice"), F.lit(False).alias("ask"), "seg", "bits",
                        F.lit(None).cast("boolean").alias("pair"), F.lit(None).cast("long").alias("h")).unionByName(
        probes.select(F.floor(seg / SLICE_SEGMENTS).alias("slice"), F.lit(True).alias("ask"), F.lit(None).cast("long").alias("seg"),
                      F.lit(None).cast("binary").alias("bits"), "pair", "h"))
    rows = rows.repartition(shuffle_partitions(parts.sparkSession), "slice").sortWithinPartitions("slice", "ask")
    return rows.mapInArrow(run, "pair boolean, h bigint, level int")


# ------------------------------------------------------------------ scoring


def sliced_scores(texts: DataFrame, parts: DataFrame, n: int, mass: int, cfg: LmConfig) -> DataFrame:
    """``rid, score`` by a filter too large to broadcast (``parts``, of ``n`` segments).
    ``texts`` (stored): the pairs of each text (``pair_h, pair_n``), and each pair of a
    batch once with its words (``new_h, new_u, new_w``)."""
    new = texts.select(F.explode(F.arrays_zip("new_h", "new_u", "new_w")).alias("t")).select("t.*")
    pairs = write_table(new.groupBy(F.col("new_h").alias("p")).agg(
        F.min("new_u").alias("u"), F.min("new_w").alias("w")), "lm-pairs")
    # every first word of a pair is the second of another: texts begin after an end token, and end with one
    probes = pairs.select(F.lit(True).alias("pair"), F.col("p").alias("h")).unionByName(
        pairs.select(F.lit(False).alias("pair"), F.col("w").alias("h")).distinct())
    counts = F.array(*[F.lit(float(x)) for x in decode(np.arange(len(cfg.thresholds()) + 1), cfg.thresholds())])
    levels = write_table(probe_slices(parts, probes, n, cfg), "lm-levels").withColumn("c", F.get(counts, F.col("level")))
    words = broadcast_if_small(levels.where("not pair").select("h", "c"))
    found = pairs.join(levels.where("pair").select(F.col("h").alias("p"), F.col("c").alias("pc")), "p")
    for x in "uw":
        found = found.join(words.select(F.col("h").alias(x), F.col("c").alias(f"{x}c")), x)
    pc, uc, wc = F.col("pc"), F.col("uc"), F.col("wc")
    p1 = (wc + 1) / F.lit(float(mass))
    both = cfg.weight * F.least(pc, uc, wc) / uc + (1 - cfg.weight) * p1
    logs = found.select("p", F.log10(F.when(uc > 0, both).otherwise(p1)).alias("log_p"))
    of = texts.select("rid", F.explode(F.arrays_zip("pair_h", "pair_n")).alias("t")).select(
        "rid", F.col("t.pair_h").alias("p"), F.col("t.pair_n").alias("times"))
    return of.join(logs, "p").groupBy("rid").agg(F.sum(F.col("times") * F.col("log_p")).alias("score"))


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    cfg: LmConfig = LmConfig()) -> DataFrame:
    """Learn from the rows where ``held_out`` is not true and score all:
    ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    ``docs``: a stored table."""
    spark = docs.sparkSession
    bounded_batches(spark)
    src = row_ids(docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                              F.col(text_col).alias("text")))
    ngrams = count_ngrams(src.where("not held_out").select("text"))
    # by power of two of the count: a table of at most 128 rows
    sizes = ngrams.groupBy("pair", F.floor(F.log2("n")).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).collect()
    words = {r["p"]: r["c"] for r in sizes if not r["pair"]}
    n, v = sum(r["s"] for r in sizes if not r["pair"]), sum(words.values())
    th = cfg.thresholds()
    n_segments = filter_segments(sum(r["c"] * int(np.searchsorted(th, r["s"] // r["c"], "right")) for r in sizes))
    sliced = n_segments * SEGMENT_BYTES > cfg.max_filter_bytes
    bits = build_filter(ngrams, 0 if sliced else n_segments, cfg)
    # the least count of a word of the head, a power of two
    least, head_size = 0, v
    while head_size > cfg.head_words:
        head_size -= words.get(least, 0)
        least += 1
    words = ngrams.where("not pair").select("h", "n")
    head = words.where(F.col("n") >= 1 << least).toArrow()
    head_h = head.column("h").to_numpy().view(np.uint64)
    order = np.argsort(head_h)
    model = spark.sparkContext.broadcast({"bits": bits, "head_h": head_h[order], "head_n": head.column("n").to_numpy()[order]})
    del bits, head, head_h
    has_tail = least > 0
    log_all = float(np.log10(n + v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            uh, ids, lens = token_ids(b.column(2))
            first = np.cumsum(lens) - lens
            # exact counts of the head
            at = np.minimum(np.searchsorted(m["head_h"], uh), max(0, len(m["head_h"]) - 1))
            c = np.where(m["head_h"][at] == uh, m["head_n"][at], 0) if len(m["head_h"]) else np.zeros(len(uh), np.int64)
            known = np.add.reduceat((c > 0)[ids].astype(np.int64), first)
            logs = np.add.reduceat(np.log10(c + 1.0)[ids], first)
            before = np.empty_like(ids)
            before[1:] = ids[:-1]
            before[first] = len(uh) - 1  # the end token
            code, back = np.unique(before * len(uh) + ids, return_inverse=True)
            left, right = code // len(uh), code % len(uh)
            which = np.repeat(np.arange(len(lens)), lens)
            arrays = [b.column(0), b.column(1), b.column(3), pa.array(lens), pa.array(known), pa.array(logs)]
            cols = ["id", "held_out", "rid", "n_tokens", "n_known", "logs"]

            def lists(owner: np.ndarray, **columns: np.ndarray) -> None:  # ``owner`` in order
                offsets = pa.array(np.r_[0, np.cumsum(np.bincount(owner, minlength=len(lens)))].astype(np.int32))
                for k, x in columns.items():
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(x)))
                    cols.append(k)

            if sliced:
                ph = pair_hash(uh[left], uh[right]).view(np.int64)
                all_pairs, times = np.unique(which * len(code) + back, return_counts=True)
                lists(all_pairs // len(code), pair_h=ph[all_pairs % len(code)], pair_n=times.astype(np.int64))
                # the words of a pair go with the first text of the batch that has it
                at = np.full(len(code), len(back))
                np.minimum.at(at, back, np.arange(len(back)))
                o = np.argsort(at)
                lists(which[at[o]], new_h=ph[o], new_u=uh[left[o]].view(np.int64), new_w=uh[right[o]].view(np.int64))
            else:
                uc = decode(probe(uh, m["bits"], n_segments, most=len(th)), th)
                seen = (uc[left] > 0) & (uc[right] > 0)
                pc = np.zeros(len(code))
                pc[seen] = decode(probe(pair_hash(uh[left[seen]], uh[right[seen]]), m["bits"], n_segments, most=len(th)), th)
                pc = np.minimum(pc, np.minimum(uc[left], uc[right]))
                p1 = (uc[right] + 1) / (n + v + 1)
                p = np.where(uc[left] > 0, cfg.weight * pc / np.maximum(uc[left], 1) + (1 - cfg.weight) * p1, p1)
                arrays.append(pa.array(np.add.reduceat(np.log10(p)[back], first)))
                cols.append("score")
            if has_tail:
                rare = c[ids] == 0
                code, times = np.unique(which[rare] * len(uh) + ids[rare], return_counts=True)
                lists(code // len(uh), tail_h=uh[code % len(uh)].view(np.int64), tail_n=times.astype(np.int64))
            yield pa.RecordBatch.from_arrays(arrays, cols)

    kind = dict(src.dtypes)["id"]
    schema = f"id {kind}, held_out boolean, rid bigint, n_tokens bigint, n_known bigint, logs double"
    schema += ", " + ", ".join(f"{c} array<bigint>" for c in ("pair_h", "pair_n", "new_h", "new_u", "new_w")) if sliced else ", score double"
    if has_tail:
        schema += ", tail_h array<bigint>, tail_n array<bigint>"
    scored = src.mapInArrow(run, schema)
    if has_tail or sliced:
        scored = write_table(scored, "lm-scores")
    if sliced:
        sums = sliced_scores(scored, filter_parts(ngrams, n_segments, cfg), n_segments, n + v + 1, cfg)
        scored = scored.drop("pair_h", "pair_n", "new_h", "new_u", "new_w").join(sums, "rid", "left")
    if has_tail:
        tail = words.where(F.col("n") < 1 << least).select("h", "n")
        rare = scored.select("rid", F.explode(F.arrays_zip("tail_h", "tail_n")).alias("t")).select(
            "rid", F.col("t.tail_h").alias("h"), F.col("t.tail_n").alias("times"))
        more = rare.join(tail, "h").groupBy("rid").agg(
            F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
        scored = scored.drop("tail_h", "tail_n").join(more, "rid", "left").withColumns({
            "n_known": F.col("n_known") + F.coalesce("more", F.lit(0)),
            "logs": F.col("logs") + F.coalesce("more_logs", F.lit(0.0))})
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                         F.lit(n).cast("long").alias("train_tokens"),
                         (F.col("logs") - F.col("n_tokens") * log_all).alias("base_score"), "score")
