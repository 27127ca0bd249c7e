"""Uniform shuffle into exact shards by a hypergeometric communication matrix.

The rows lie in blocks; the shards are cut into bins of exact sizes. How many
rows of each block go to each bin is drawn from the multivariate hypergeometric
distribution, which is the law that a uniformly random permutation of all rows
would give. Then each block is permuted on its own and dealt out by its counts,
the rows are exchanged, and each bin is permuted on its own. The result is a
uniform shuffle in which every shard has exactly its size.

The matrix is drawn by halving: the column totals of a range of blocks are
divided between its two halves, one univariate hypergeometric draw per column
(inversion of the distribution, from the mode outwards), until every block has
its own row. Levels run as DataFrame steps over one row per range, so the matrix
is never in one place; there are at most ``max_blocks`` blocks and bins.

Scale: rows carry (row number, id, size, checksum) only. Blocks come from a hash
of the row number and bins have exact sizes, so no key can make one large; both
windows run over one block or one bin. Counting the blocks is a partial aggregate.

Edge cases: a null text has no bytes; repeated rows and null ids are rows like
any other; with fewer rows than shards the first shards have one row each; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.util import let
from ..session import write_table
from .common import row_ids


@dataclass(frozen=True)
class ShardConfig:
    n_shards: int = 8
    seed: int = 20240607
    #: rows of a block, while there are at most ``max_blocks`` blocks
    block_rows: int = 1 << 16
    max_blocks: int = 4096


# ------------------------------------------------------------------ draws


def uniform(*parts) -> Column:
    """A number in [0, 1) that depends on ``parts`` only."""
    h = F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.shiftrightunsigned(h, 11).cast("double") * F.lit(2.0 ** -53)


def log_factorial(n: Column) -> Column:
    """ln n!: exact logarithm up to 20, Stirling's series beyond (error below 1e-15 relative)."""
    x = n.cast("double")
    big = F.greatest(x, F.lit(20.0))
    series = 1 / (12 * big) - 1 / (360 * big * big * big) + 1 / (1260 * big * big * big * big * big)
    stirling = big * F.log(big) - big + 0.5 * F.log(2 * F.lit(math.pi) * big) + series
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(stirling)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` rows out of ``total`` are among its ``good`` ones:
    the value at which the probabilities, added up from the mode outwards
    (mode, mode + 1, mode - 1, mode + 2, ...), pass ``u``."""
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - good))
    high = F.least(good, drawn)
    mode = F.least(F.greatest(F.floor((drawn + 1).cast("double") * (good + 1).cast("double")
                                      / (total + 2).cast("double")).cast("long"), low), high)

    def draw(p: Column) -> Column:
        t, g, d, lo, hi, m = (p[x].cast("double") for x in ("t", "g", "d", "lo", "hi", "m"))
        lp = log_choose(p["g"], p["m"]) + log_choose(p["t"] - p["g"], p["d"] - p["m"]) - log_choose(p["t"], p["d"])
        var = d * (g / F.greatest(t, F.lit(1.0))) * (1 - g / F.greatest(t, F.lit(1.0)))
        # beyond ten standard deviations (and 50) nothing of double precision is left
        steps = F.least(p["hi"] - p["lo"], F.ceil(10 * F.sqrt(var)).cast("long") + 50)
        zero = F.struct((p["u"] - F.exp(lp)).alias("left"), F.exp(lp).alias("up"), F.exp(lp).alias("down"),
                        F.when(p["u"] < F.exp(lp), p["m"]).otherwise(F.lit(-1).cast("long")).alias("x"))

        def step(acc: Column, i: Column) -> Column:
            a, b = m + i - 1, m - i + 1  # the values reached so far on both sides
            up = F.when(a + 1 <= hi, acc["up"] * (g - a) * (d - a) / ((a + 1) * (t - g - d + a + 1))).otherwise(0.0)
            down = F.when(b - 1 >= lo, acc["down"] * b * (t - g - d + b) / ((g - b + 1) * (d - b + 1))).otherwise(0.0)
            x = (F.when(acc["x"] >= 0, acc["x"]).when(acc["left"] < up, p["m"] + i)
                 .when(acc["left"] < up + down, p["m"] - i).otherwise(F.lit(-1).cast("long")))
            return F.struct((acc["left"] - up - down).alias("left"), up.alias("up"), down.alias("down"), x.alias("x"))

        got = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1).cast("long"))), zero, step)
        return F.when(p["hi"] == p["lo"], p["lo"]).otherwise(
            let(got["x"], lambda x: F.when(x >= 0, x).otherwise(p["m"])))

    return let(F.struct(total.alias("t"), good.alias("g"), drawn.alias("d"), low.alias("lo"), high.alias("hi"),
                        mode.alias("m"), u.alias("u")), draw)


def communication_matrix(blocks: DataFrame, bins: list[int], n_blocks: int, seed: int) -> DataFrame:
    """``block, counts``: rows of each block for each bin. ``blocks``: (block
    0..n_blocks - 1, n). Each level halves every range of blocks."""
    spark = blocks.sparkSession
    width = 1 << max(0, (n_blocks - 1).bit_length())
    total = sum(bins)
    levels = spark.range(1).select(F.lit(0).cast("long").alias("lo"), F.lit(total).cast("long").alias("n"),
                                   F.array(*[F.lit(b).cast("long") for b in bins]).alias("cols"))
    while width > 1:
        half = width // 2
        # rows in the left half of each range
        left = blocks.groupBy((F.floor(F.col("block") / width) * width).cast("long").alias("lo")).agg(
            F.sum(F.when(F.col("block") % width < half, F.col("n")).otherwise(0)).alias("nl"))
        node = levels.join(F.broadcast(left), "lo")  # at most max_blocks rows

        def split(acc: Column, c: Column) -> Column:
            # column by column: what is left of the draws, of the rows, and the counts so far
            x = hypergeometric(acc["rest"], c, acc["draws"], uniform(seed, F.col("lo"), half, F.size(acc["out"])))
            return let(x, lambda v: F.struct((acc["rest"] - c).alias("rest"), (acc["draws"] - v).alias("draws"),
                                             F.concat(acc["out"], F.array(v)).alias("out")))

        zero = F.struct(F.col("n").cast("long").alias("rest"), F.col("nl").cast("long").alias("draws"),
                        F.array().cast("array<bigint>").alias("out"))
        node = node.select("lo", "n", "nl", "cols", F.aggregate("cols", zero, split)["out"].alias("lcols"))
        right = F.zip_with("cols", "lcols", lambda a, b: a - b)
        node = node.select(F.explode(F.array(
            F.struct(F.col("lo"), F.col("nl").alias("n"), F.col("lcols").alias("cols")),
            F.struct((F.col("lo") + half).alias("lo"), (F.col("n") - F.col("nl")).alias("n"), right.alias("cols")))).alias("x"))
        levels = node.select("x.lo", "x.n", "x.cols").where("n > 0")
        width = half
        if width & 0b1010101010:  # cut the lineage now and then
            levels = write_table(levels, "matrix")
    return levels.select(F.col("lo").alias("block"), F.col("cols").alias("counts"))


# ------------------------------------------------------------------ shuffle


def bin_sizes(n_rows: int, cfg: ShardConfig) -> list[tuple[int, int]]:
    """(shard, rows) of each bin: shard sizes at most one apart, each shard cut
    into bins of about ``block_rows`` (more once there are ``max_blocks``)."""
    per_bin = max(cfg.block_rows, -(-n_rows // max(1, cfg.max_blocks - cfg.n_shards)))
    out = []
    for s in range(cfg.n_shards):
        size = n_rows // cfg.n_shards + (s < n_rows % cfg.n_shards)
        k = max(1, -(-size // per_bin))
        out += [(s, size // k + (i < size % k)) for i in range(k)]
    return out


def shuffle_to_shards(df: DataFrame, cfg: ShardConfig = ShardConfig(), rid_col: str = "_rid") -> DataFrame:
    """``df`` (a stored table with unique ``rid_col``) with ``shard`` and ``slot``."""
    spark = df.sparkSession
    n = df.count()
    bins = bin_sizes(n, cfg)
    n_blocks = max(1, min(cfg.max_blocks, -(-n // cfg.block_rows)))
    block = F.pmod(F.xxhash64(rid_col, F.lit(cfg.seed)), F.lit(n_blocks)).cast("long")
    rows = df.withColumn("_block", block)
    sizes = write_table(rows.groupBy(F.col("_block").alias("block")).agg(F.count(F.lit(1)).alias("n")), "blocks")
    matrix = communication_matrix(sizes, [b for _, b in bins], n_blocks, cfg.seed)
    # ends of the runs of the permuted block that go to each bin
    runs = matrix.select("block", F.posexplode("counts").alias("_bin", "_c"))
    ends = Window.partitionBy("block").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.select("block", "_bin", "_c", F.sum("_c").over(ends).alias("_end")).where("_c > 0")
    runs = runs.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("_end", "_bin"))).alias("_runs"))
    inside = Window.partitionBy("_block").orderBy(uniform(cfg.seed + 1, F.col(rid_col)), rid_col)
    permuted = rows.withColumn("_rank", F.row_number().over(inside))
    dealt = permuted.join(runs.withColumnRenamed("block", "_block"), "_block")
    # the first run whose end is not before the rank, by bisection
    dealt = dealt.withColumn("_bin", _bisect(F.col("_runs"), F.col("_rank")))
    shard = spark.createDataFrame([(i, s, 0) for i, (s, _) in enumerate(bins)], "_bin int, shard int, _x int")
    starts, before = [], {}
    for i, (s, size) in enumerate(bins):
        starts.append((i, s, before.get(s, 0)))
        before[s] = before.get(s, 0) + size
    shard = spark.createDataFrame(starts, "_bin int, shard int, _start bigint")
    within = Window.partitionBy("_bin").orderBy(uniform(cfg.seed + 2, F.col(rid_col)), rid_col)
    slot = dealt.withColumn("_slot", F.row_number().over(within) - 1).join(F.broadcast(shard), "_bin")
    return slot.select(*df.columns, "shard", (F.col("_start") + F.col("_slot")).alias("slot"))


def _bisect(runs: Column, rank: Column) -> Column:
    """``_bin`` of the first run with ``_end >= rank`` (at most 2^13 runs)."""
    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["a"] + acc["b"]) / 2).cast("int")
        right = F.get(runs, mid)["_end"] < rank
        return F.struct(F.when(right, mid + 1).otherwise(acc["a"]).alias("a"),
                        F.when(right, acc["b"]).otherwise(mid).alias("b"))

    zero = F.struct(F.lit(0).alias("a"), (F.size(runs) - 1).alias("b"))
    steps = F.ceil(F.log2(F.size(runs).cast("double") + 1)).cast("int")
    at = F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), zero, halve)["a"]
    return F.get(runs, at)["_bin"]


def shard_documents(docs: DataFrame, cfg: ShardConfig = ShardConfig(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: ``id, size, text_crc32, shard, slot``. ``docs``: a stored table."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = row_ids(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32")))
    out = shuffle_to_shards(write_table(src, "shard-rows"), cfg)
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
