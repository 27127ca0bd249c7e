import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import sharding as S


def pmf(x, total, good, drawn):
    return math.comb(good, x) * math.comb(total - good, drawn - x) / math.comb(total, drawn)


@pytest.mark.parametrize("total,good,drawn", [(10, 4, 5), (50, 7, 20), (30, 30, 12), (40, 1, 39), (9, 0, 4)])
def test_draws_follow_the_law(spark, total, good, drawn):
    n = 20000
    u = (F.col("id") + 0.5) / n  # an even grid: each value comes up as often as its probability
    x = S.hypergeometric(*(F.lit(v).cast("long") for v in (total, good, drawn)), u)
    seen = {r.x: r["count"] for r in spark.range(n).select(x.alias("x")).groupBy("x").count().collect()}
    for k in range(max(0, drawn - total + good), min(good, drawn) + 1):
        assert abs(seen.get(k, 0) / n - pmf(k, total, good, drawn)) < 2 / n + 1e-9
    assert sum(seen.values()) == n


def test_log_factorial(spark):
    for n in (0, 1, 5, 20, 21, 100, 12345, 10**9):
        got = spark.range(1).select(S.log_factorial(F.lit(n).cast("long"))).first()[0]
        assert math.isclose(got, math.lgamma(n + 1), rel_tol=1e-12, abs_tol=1e-12)


def test_matrix_has_exact_margins(spark):
    sizes = [7, 0, 31, 12, 50]
    bins = [40, 1, 0, 59]
    blocks = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "block long, n long")
    got = {r.block: list(r.counts) for r in S.communication_matrix(blocks, bins, len(sizes), 3).collect()}
    assert all(sum(got.get(i, [0])) == n for i, n in enumerate(sizes))
    assert [sum(c) for c in zip(*got.values())] == bins
    assert min(min(c) for c in got.values()) >= 0


@pytest.mark.parametrize("cfg", [S.ShardConfig(), S.ShardConfig(block_rows=20), S.ShardConfig(block_rows=1, max_blocks=24)])
def test_exact_sizes_and_gapless_slots(spark, stored, cfg):
    rows = [(i % 50 if i % 7 else None, None if i % 11 == 0 else "té" * (i % 5)) for i in range(203)]
    got = S.shard_documents(stored(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as _block"), cfg).collect()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want


def test_no_trace_of_the_order(spark, stored):
    """Neither shard nor slot depends on where a row was."""
    df = stored([(i, "x") for i in range(4000)], "doc_id long, text string", 2)
    rows = S.shard_documents(df, S.ShardConfig(block_rows=500)).collect()
    seen = collections.Counter((r.doc_id // 500, r.shard) for r in rows)
    chi = sum((seen[(b, s)] - 62.5) ** 2 / 62.5 for b in range(8) for s in range(8))
    assert 15 < chi < 95  # 49 degrees of freedom
    for s in range(8):
        pairs = [(r.doc_id, r.slot) for r in rows if r.shard == s]
        ids, slots = (np.array(x, float) for x in zip(*pairs))
        assert abs(np.corrcoef(ids, slots)[0, 1]) < 0.2  # 4.5 deviations


def test_few_rows_and_none(spark, stored):
    got = S.shard_documents(stored([(1, "a"), (2, "b")], "doc_id long, text string", 1)).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (1, 0)]
    assert S.shard_documents(stored([], "doc_id long, text string", 1)).count() == 0
