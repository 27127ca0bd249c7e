"""Exact n-gram Jaccard self-join as a join in a metric space.

A document is the set of its distinct word shingles; Jaccard distance (1 minus
similarity) is a metric. Documents link when they are at most eps = 1 - threshold
apart, and the operator returns the classes that links make.

1. Equal sets (distance 0) are one class; only one representative of each goes on.
2. A set with a partner shares at least ``threshold`` of its shingles with it. One
   pass counts, for each document, how many of its shingles occur in another
   document; who has fewer has no partner, exactly. Shingles travel as packed
   blocks by hash range, those that repeat within a task once per task.
3. What is left is arranged around pivots. Every shingle of a document's prefix
   (its rarest shingles, just as many that two linked sets must share one of
   them) nominates as pivot the set with the fewest shingles of its own among
   those that have it there. A document's region is that of each of its pivots, so
   linked documents share a region (Voronoi cells whose boundary documents are
   replicated to the cells of all their pivots).
4. The distances to the pivots are computed exactly. Documents within eps of a
   pivot link to it, and need not be compared with one another. By the triangle
   inequality |d(a, p) - d(b, p)| <= eps for linked a and b, so of a region only
   documents outside the pivot's ball, and the shell of the ball that is within eps
   of one of them, remain. They form a new region, which is joined in the same way
   around new pivots (recursion).
5. Regions left after ``rounds`` are joined exactly in blocks: members are cut
   into chunks of bounded weight, and each pair of chunks is a task.
6. Links are contracted to components by minimum labels with pointer jumping.

The plain form of the method, with windows of 2 eps around sampled pivots, does
not prune on texts: unrelated documents are all at distance 1 from every
pivot and from each other, so that every document would be replicated
to every region. Pivots nominated by shared rare shingles give each document
with a partner a pivot nearer than 1.

Scale: nothing is compared that shares no rare shingle; a group of copies is one
representative, a group of near copies a star around its pivot, so neither makes
all pairs. No group is collected whole: pivots come from partial aggregates,
regions are pruned in joins (AQE splits hot ones), the rest is cut into chunks.
There is no cap on partners, candidates or region sizes.

Edge cases: a null or empty text has an empty set and links with nothing; fewer
words than a shingle are one shingle; repeated rows and ids are rows of their
own; a class takes the smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import broadcast_if_small, write_table
from .common import bounded_batches, row_ids
from .words import runs
from .log_frequency_lm import pair_hash, word_hashes


@dataclass(frozen=True)
class JoinConfig:
    shingle: int = 4
    #: link when 100 * intersection >= percent * union
    percent: int = 85
    #: shingles of a hash range (one reduce group), about
    range_shingles: int = 1 << 22
    #: shingles of a chunk of a region that is joined in one task
    chunk_shingles: int = 1 << 20
    rounds: int = 3


FLUSH = 1 << 20  # shingles that a task holds at a time; sorting them takes some ten arrays of that length

# ------------------------------------------------------------------ sets


def shingle_sets(texts: list[bytes | None], k: int, cache: dict[bytes, int]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (64 bits) of each UTF-8 text."""
    split = [(t or b"").lower().split() for t in texts]
    names: dict[bytes, int] = {}
    flat = [names.setdefault(w, len(names)) for words in split for w in words]
    h = word_hashes(list(names), cache)[np.array(flat, np.int64)] if flat else np.zeros(0, np.uint64)
    run = h.copy()
    for j in range(1, k):
        run = pair_hash(run[:-1], h[j:]) if len(run) > 1 else run[:0]
    out, at = [], 0
    for words in split:
        n = len(words)
        if n >= k:
            out.append(np.unique(run[at:at + n - k + 1]))
        elif n:
            one = h[at:at + 1]
            for j in range(1, n):
                one = pair_hash(one, h[at + j:at + j + 1])
            out.append(pair_hash(one, np.array([n], np.uint64)))  # apart from longer runs
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def batch_sets(texts: pa.Array, k: int, cache: dict[bytes, int]) -> Iterator[np.ndarray]:
    """``shingle_sets`` of a column, a bounded run of texts at a time."""
    for part in runs(texts.cast(pa.binary())):
        yield from shingle_sets(part.to_pylist(), k, cache)


def document_sets(src: DataFrame, k: int) -> DataFrame:
    """``rid, id, n, sig``: size and 128-bit signature of each row's set. ``src``: rid, id, text."""
    kind = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for b in batches:
            known = [(len(s), xxhash.xxh3_128_digest(s.tobytes())) for s in batch_sets(b.column(2), k, cache)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([n for n, _ in known], pa.int64()),
                 pa.array([sig for _, sig in known], pa.binary())], ["rid", "id", "n", "sig"])

    return src.mapInArrow(run, f"rid bigint, id {kind}, n bigint, sig binary")


def sets_of(src: DataFrame, k: int) -> DataFrame:
    """``x, n, s``: the shingles themselves (sorted by unsigned value). ``src``: rid, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for b in batches:
            sets = list(batch_sets(b.column(1), k, cache))
            lens = np.fromiter(map(len, sets), np.int64, len(sets))
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lens), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["x", "n", "s"])

    return src.mapInArrow(run, "x bigint, n bigint, s array<bigint>")


# ------------------------------------------------------------------ shingles that occur elsewhere


def shared_counts(src: DataFrame, k: int, total: int, cfg: JoinConfig) -> DataFrame:
    """``rid, shared``: shingles of each row that some other row has, or a few
    more (32 bits of a hash are compared within a range). ``src``: rid, text."""
    bits = max(6, (max(1, -(-total // cfg.range_shingles)) - 1).bit_length())
    names = ["r", "rids", "lens", "own", "common", "counted", "counts"]

    def pack(sets: list[np.ndarray], rids: list[int]) -> Iterator[pa.RecordBatch]:
        rid = np.array(rids, np.int64)
        h = np.concatenate(sets)
        doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]
        first = np.r_[True, h[1:] != h[:-1]]
        single = first & np.r_[first[1:], True]
        local = np.bincount(doc[~single], minlength=len(sets))
        bucket = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
        low = ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        rows = []
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, z in zip(cut, np.r_[cut[1:], len(h)]):
            mine = single[a:z]
            d = doc[a:z][mine]
            by_doc = np.argsort(d, kind="stable")
            own, lens = np.unique(d, return_counts=True)
            rows.append((int(bucket[a]), rid[own].tobytes(), lens.astype(np.uint32).tobytes(),
                         low[a:z][mine][by_doc].tobytes(), low[a:z][~mine & first[a:z]].tobytes(), b"", b""))
        some = np.flatnonzero(local)
        to = rid[some] % (1 << bits)
        by_range = np.argsort(to, kind="stable")
        some, to = some[by_range], to[by_range]
        cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else []
        for a, z in zip(cut, np.r_[cut[1:], len(to)] if len(to) else []):
            rows.append((int(to[a]), b"", b"", b"", b"", rid[some[a:z]].tobytes(), local[some[a:z]].astype(np.int64).tobytes()))
        for i in range(0, len(rows), 64):
            cols = list(zip(*rows[i:i + 64]))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64())] + [pa.array(c, pa.binary()) for c in cols[1:]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        sets, rids, size = [], [], 0
        for b in batches:
            for rid, s in zip(b.column(0).to_pylist(), batch_sets(b.column(1), k, cache)):
                if len(s):
                    sets.append(s)
                    rids.append(rid)
                    size += len(s)
                if size >= FLUSH:
                    yield from pack(sets, rids)
                    sets, rids, size = [], [], 0
        if sets:
            yield from pack(sets, rids)

    def count(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        h, common = joined("own", np.uint32), np.unique(joined("common", np.uint32))
        rid = np.repeat(joined("rids", np.int64), joined("lens", np.uint32))
        order = np.argsort(h, kind="stable")
        h, rid = h[order], rid[order]
        same = h[1:] == h[:-1]
        hit = np.r_[False, same] | np.r_[same, False] if len(h) else np.zeros(0, bool)
        if len(common):
            hit |= common[np.minimum(np.searchsorted(common, h), len(common) - 1)] == h
        docs = np.concatenate([rid[hit], joined("counted", np.int64)])
        n = np.concatenate([np.ones(int(hit.sum()), np.int64), joined("counts", np.int64)])
        u, at = np.unique(docs, return_inverse=True)
        return pa.table({"rid": pa.array(u, pa.int64()),
                         "shared": pa.array(np.bincount(at, weights=n, minlength=len(u)).astype(np.int64))})

    packed = src.mapInArrow(run, "r bigint, rids binary, lens binary, own binary, common binary, counted binary, counts binary")
    return packed.groupBy("r").applyInArrow(count, "rid bigint, shared bigint").groupBy("rid").agg(F.sum("shared").alias("shared"))


# ------------------------------------------------------------------ pivots and regions


def prefixes(sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    """``x, n, h, own``: the shingles of each set that another set has, rarest
    first, as many that a linked pair must share one; ``own`` is the share of
    the set's shingles that no other set has."""
    post = sets.select("x", "n", F.explode("s").alias("h"))
    common = post.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    rows = post.join(common, "h")
    w = Window.partitionBy("x")
    need = F.ceil(F.col("n") * cfg.percent / F.lit(100.0))
    ranked = rows.select("x", "n", "h", F.row_number().over(w.orderBy("c", "h")).alias("i"),
                         F.count(F.lit(1)).over(w).alias("m"))
    return ranked.where(F.col("i") <= F.col("m") - need + 1).select(
        "x", "n", "h", (1 - F.col("m") / F.col("n")).alias("own"))


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``x, p, inter, union`` of pairs (x, p), exactly."""
    a = sets.select(F.col("x"), F.col("s").alias("sx"))
    z = sets.select(F.col("x").alias("p"), F.col("s").alias("sp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            inter, union = [], []
            for i in range(b.num_rows):
                u, v = (b.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (2, 3))
                small, large = (u, v) if len(u) <= len(v) else (v, u)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                n = int((large[at] == small).sum())
                inter.append(n)
                union.append(len(u) + len(v) - n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(inter, pa.int64()), pa.array(union, pa.int64())], ["x", "p", "inter", "union"])

    both = pairs.join(a, "x").join(z, "p").select("x", "p", "sx", "sp")
    return both.mapInArrow(run, "x bigint, p bigint, inter bigint, union bigint")


def pivot_round(posts: DataFrame, sets: DataFrame, cfg: JoinConfig) -> tuple[DataFrame, DataFrame]:
    """One level of regions: links (x, y) to pivots, and the posts that remain.

    ``posts`` (stored): region ``g``, shingle ``h``, document ``x`` with ``n``,
    ``own`` and ``cls`` (a pivot it is linked to, else null). Pivots are sought
    among documents without a class first.
    """
    eps = 1 - cfg.percent / 100 + 1e-9
    order = F.struct(F.col("cls").isNotNull().alias("tied"), "own", "n", "x")
    groups = posts.groupBy("g", "h").agg(
        F.count(F.lit(1)).alias("c"), F.count("cls").alias("t"), F.min("cls").alias("lo"), F.max("cls").alias("hi"),
        F.min(order).alias("p"))
    # documents of one class are linked already
    groups = groups.where((F.col("c") > 1) & ((F.col("t") < F.col("c")) | (F.col("lo") != F.col("hi"))))
    members = write_table(posts.join(groups.select("g", "h", F.col("p.x").alias("p"), F.col("p.tied").alias("p_tied")),
                                     ["g", "h"]).where("x <> p"), "members")
    dist = write_table(distances(members.select("x", "p").distinct(), sets), "distances")
    near = 100 * F.col("inter") >= cfg.percent * F.col("union")
    links = dist.where(near).select("x", F.col("p").alias("y"))
    d = members.join(dist, ["x", "p"]).select(
        F.xxhash64("g", "p").alias("g"), "p", "h", "x", "n", "own", (1 - F.col("inter") / F.col("union")).alias("d"),
        F.when(F.col("cls").isNotNull(), F.col("cls")).when(near, F.col("p")).alias("cls"))
    d = write_table(d, "regions")
    # the shell: of a region whose tied documents are of one class, those within eps of an untied one
    span = d.groupBy("g").agg(F.min(F.when(F.col("cls").isNull(), F.col("d"))).alias("free_lo"),
                              F.max(F.when(F.col("cls").isNull(), F.col("d"))).alias("free_hi"),
                              F.min("cls").alias("lo"), F.max("cls").alias("hi"))
    span = span.where(F.col("free_lo").isNotNull() | (F.col("lo") != F.col("hi")))
    left = d.join(broadcast_if_small(write_table(span, "region-spans")), "g").where(
        F.col("cls").isNull() | (F.col("lo") != F.col("hi"))
        | ((F.col("d") >= F.col("free_lo") - eps) & (F.col("d") <= F.col("free_hi") + eps)))
    return links, left.select("g", "h", "x", "n", "own", "cls", "d")


def join_regions(left: DataFrame, sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Links (x, y) among the members of the regions that remain, exactly:
    every two members of a region meet in the task of their chunks."""
    members = left.groupBy("g", "x").agg(F.max("n").alias("n"), F.max("cls").alias("cls"), F.max("d").alias("d"))
    weight = members.groupBy("g").agg(F.ceil(F.sum("n") / F.lit(float(cfg.chunk_shingles))).cast("int").alias("k"),
                                      F.count(F.lit(1)).alias("c")).where("c > 1").select("g", "k")
    cut = members.join(weight, "g").withColumn("a", F.pmod(F.xxhash64("x"), F.col("k")).cast("int"))
    tasks = cut.select("g", "x", "cls", "d", "a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("b"))
    tasks = tasks.select("g", "x", "cls", "d", "a", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"))
    eps, percent = 1 - cfg.percent / 100 + 1e-9, cfg.percent

    def solve(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        x, d, part = (t.column(c).to_numpy() for c in ("x", "d", "a"))
        cls = t.column("cls").to_pylist()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sets_ = [v.values.to_numpy(zero_copy_only=False) for v in t.column("s")]
        lens = np.array([len(s) for s in sets_], np.int64)
        parent = list(range(len(x)))

        def root(a: int) -> int:
            while parent[a] != a:
                parent[a] = parent[parent[a]]
                a = parent[a]
            return a

        heads: dict[int, int] = {}
        for a, c in enumerate(cls):
            if c is not None:
                parent[root(a)] = root(heads.setdefault(c, a))
        words, inv = np.unique(np.concatenate(sets_), return_inverse=True)
        who = np.repeat(np.arange(len(x)), lens)
        order = np.argsort(inv, kind="stable")
        offsets = np.r_[0, np.cumsum(np.bincount(inv, minlength=len(words)))]
        posting = who[order]
        starts = np.r_[0, np.cumsum(lens)]
        out_x, out_y = [], []
        for a in range(len(x)):
            if i != j and part[a] != i:
                continue
            own = inv[starts[a]:starts[a + 1]]
            seen = np.bincount(np.concatenate([posting[offsets[w]:offsets[w + 1]] for w in own]), minlength=len(x))
            fit = (100 * seen >= percent * (lens[a] + lens - seen)) & (np.abs(d - d[a]) <= eps)
            if i != j:
                fit &= part == j
            for b in np.flatnonzero(fit).tolist():
                ra, rb = root(a), root(b)
                if ra != rb:
                    parent[ra] = rb
                    out_x.append(int(x[a]))
                    out_y.append(int(x[b]))
        return pa.table({"x": pa.array(out_x, pa.int64()), "y": pa.array(out_y, pa.int64())})

    return tasks.join(sets.select("x", "s"), "x").groupBy("g", "i", "j").applyInArrow(solve, "x bigint, y bigint")


def components(edges: DataFrame) -> DataFrame:
    """``x, c``: the smallest x of each x's component. ``edges`` (x, y) stored."""
    both = write_table(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = write_table(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("c")), "labels")
    while True:
        low = both.join(broadcast_if_small(labels.select(F.col("x").alias("y"), "c")), "y").groupBy("x").agg(F.min("c").alias("m"))
        hooked = write_table(labels.join(low, "x").select("x", "c", F.least("c", "m").alias("m")), "hooked")
        jump = broadcast_if_small(hooked.select(F.col("x").alias("m"), F.col("m").alias("mm")))
        moved = write_table(hooked.join(jump, "m").select("x", F.least("m", "mm").alias("c"), F.col("c").alias("was")), "labels")
        labels = moved.select("x", "c")
        if moved.where("c <> was").isEmpty():
            return labels


def link_classes(src: DataFrame, cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """``rid, id, n, group, component_id`` for ``src`` (rid, id, text; a stored
    table with unique rid); ``group`` is null for rows without a copy or link."""
    spark = src.sparkSession
    bounded_batches(spark)
    rows = write_table(document_sets(src, cfg.shingle), "document-sets")
    classes = write_table(rows.where("n > 0").groupBy("sig").agg(
        F.min("rid").alias("x"), F.min("id").alias("min_id"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")), "classes")
    total = classes.agg(F.coalesce(F.sum(F.col("n") * F.col("copies")), F.lit(0))).first()[0]
    text = src.select("rid", "text")
    shared = shared_counts(text, cfg.shingle, total, cfg)
    able = classes.join(shared, F.col("x") == F.col("rid")).where(100 * F.col("shared") >= cfg.percent * F.col("n"))
    able = write_table(able.select(F.col("x").alias("rid")), "candidates")
    sets = write_table(sets_of(text.join(broadcast_if_small(able), "rid", "left_semi"), cfg.shingle), "sets")
    posts = prefixes(sets, cfg).select(F.lit(0).cast("long").alias("g"), "h", "x", "n", "own",
                                       F.lit(None).cast("long").alias("cls"), F.lit(0.0).alias("d"))
    posts = write_table(posts, "posts")
    links = []
    for _ in range(cfg.rounds):
        found, posts = pivot_round(posts, sets, cfg)
        links.append(found)
        posts = write_table(posts, "posts")
        if posts.isEmpty():
            break
    else:
        links.append(join_regions(posts, sets, cfg))
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    labels = components(write_table(edges, "links"))
    # smallest id of each component, then of each class
    named = classes.join(labels, "x", "left").withColumn("c", F.coalesce("c", "x"))
    least = named.groupBy("c").agg(F.min("min_id").alias("component_id"), F.sum("copies").alias("size")).where("size > 1")
    by_class = write_table(named.join(least, "c").select("sig", "c", "component_id"), "class-components")
    out = rows.join(broadcast_if_small(by_class), "sig", "left")
    return out.select("rid", "id", "n", F.col("c").alias("group"), F.when(F.col("n") == 0, F.col("id")).otherwise(
        F.coalesce("component_id", "id")).alias("component_id"))


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """Per row: ``id, n_shingles, component_id``. Rows are numbered once, in a table of
    their own, so the numbers hold whatever cuts the scans of the steps make."""
    src = write_table(row_ids(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "rid")
                      .select("rid", "id", "text"), "numbered")
    out = link_classes(src, cfg)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """The rows of ``docs`` (numbered once, in a table) without near duplicates: of each
    group the row with the smallest id (null last), then the first in the
    table. Rows without words stay. All columns are as they were."""
    src = write_table(row_ids(docs.select(F.struct("*").alias("row")), "rid"), "numbered")
    text = src.select("rid", F.col(f"row.{id_col}").alias("id"), F.col(f"row.{text_col}").alias("text"))
    grouped = write_table(link_classes(text, cfg).where("group is not null").select("rid", "id", "group"), "groups")
    first = grouped.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("m"))
    later = grouped.join(first.select("group", F.col("m.rid").alias("keep")), "group").where("rid <> keep").select("rid")
    return src.join(broadcast_if_small(write_table(later, "duplicates")), "rid", "left_anti").select("row.*")
