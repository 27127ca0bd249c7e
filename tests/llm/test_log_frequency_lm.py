import collections
import math
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lexiflow.llm import log_frequency_lm as L

TEXTS = [None, "", "a b a", "A\tB  a\n", "x", "the cat sat on the mat", "the cat ate the rat", "é É zz", "q " * 400]


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2



def tok(t):
    return (t or "").encode().lower().split() + [b"\n"]


def plain(rows):
    c = collections.Counter()
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 7 != 2:
            c.update(tok(t))
    n, v = sum(c.values()), len(c)
    return n, [(d, len(tok(t)), sum(x in c for x in tok(t)), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tok(t))) for d, t in rows]


@pytest.mark.parametrize("cfg", [L.LmConfig(), L.LmConfig(head_words=3), L.LmConfig(head_words=0)])
def test_base_is_exact(spark, stored, cfg):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(None, "the end"), (5, "twice"), (5, "twice")]
    df = stored(rows, "doc_id long, text string").selectExpr("*", "1 as h", "2 as n_known", "3 as rid")
    n, want = plain(rows)
    got = L.score_documents(df, held(), cfg=cfg).collect()
    key = lambda x: (str(x[0]), x[1], x[2], round(x[3], 6))
    assert sorted(map(key, [(r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got])) == sorted(map(key, want))
    assert {r.train_tokens for r in got} == {n}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def test_tokens_are_numbered_without_an_object_each(monkeypatch):
    """What a batch costs in Python follows its distinct words, not all of them."""
    texts = [*TEXTS, " ", "\n", "\x0b a\x1cb\x85 \x0c", "  Zz  ", "É\u2003é\u00a0x", "A" * 70000, "the cat " * 5000, None]
    seen = []
    monkeypatch.setattr(L, "xxhash", types.SimpleNamespace(xxh64_intdigest=lambda w: (seen.append(w), xxhash.xxh64_intdigest(w))[1]))
    whole = pa.array(["cut off", *texts, "cut off"])
    for part in (texts, texts[:1], [""], [" "], []):
        for column in (pa.array(part, pa.string()), whole.slice(1, len(part)) if part[:2] == texts[:2] else pa.array(part, pa.large_string())):
            seen.clear()
            h, at, lens = L.token_ids(column)
            want = [tok(t) for t in part]
            assert lens.tolist() == [len(x) for x in want]
            assert h[at].tolist() == [xxhash.xxh64_intdigest(w) for x in want for w in x]
            assert len(seen) == len(set(seen)) == len(h) and set(seen) - {b""} == {w for x in want for w in x} | {b"\n"}
            assert seen[-1] == b"\n"


def test_counts_of_batches_add_up(spark, stored):
    """Every word and pair once, with its count."""
    df = stored([(i, TEXTS[i % len(TEXTS)]) for i in range(200)], "doc_id long, text string").select("text")
    want = collections.Counter()
    for (t,) in df.collect():
        h = [xxhash.xxh64_intdigest(w) for w in tok(t)]
        want.update((False, x) for x in h)
        pairs = L.pairs_of(np.array(h, np.uint64), np.array([len(h)]))
        want.update((True, int(x)) for x in pairs)
    got = [(r.pair, r.h % (1 << 64), r.n) for r in L.count_ngrams(df).collect()]
    assert len(got) == len(want) and {x[:2]: x[2] for x in got} == want


def test_filter_gives_levels_back():
    rng = np.random.default_rng(0)
    h = np.unique(rng.integers(0, 1 << 63, 30000).astype(np.uint64) * np.uint64(2))
    level = rng.integers(1, 6, len(h))
    n = int(np.ceil(level.sum() * L.HASHES / np.log(2) / L.SEGMENT_BITS))
    bits: dict = {}
    L.build_segments(h, level, L.segments(h, n), bits)
    flat = np.concatenate([np.packbits(bits[s], bitorder="little") for s in range(n)])
    got = L.probe(h, flat, n)
    assert (got >= level).all()  # never below
    assert (got > level).mean() < 0.09  # 2 ** -HASHES, about
    other = rng.integers(0, 1 << 63, 30000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert (L.probe(other, flat, n) > 0).mean() < 0.09


def test_levels_and_counts():
    th = L.LmConfig().thresholds()
    assert th[:6].tolist() == [1, 2, 3, 4, 6, 8] and (np.diff(th) > 0).all()
    assert L.decode(np.array([0, 1, 2, 4, 5]), th).tolist() == [0, 1, 2, 4.5, 6.5]


def test_held_out_text_scores_above_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = L.score_documents(docs, held()).where("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert r[0] > r[1] + 0.3  # decimal digits per token


def test_word_order_matters(spark, stored):
    rows = [(i, "red fox runs far away") for i in range(60)] + [(1000, "away far runs fox red"), (1001, "red fox runs far away")]
    got = {r.doc_id: r.score for r in L.score_documents(stored(rows, "doc_id long, text string"), F.col("doc_id") >= 1000).collect()}
    assert got[1001] > got[1000] + 3


def test_empty(spark, stored):
    assert L.score_documents(stored([], "doc_id long, text string", 1), held()).count() == 0
    r = L.score_documents(stored([(1, "a b")], "doc_id long, text string", 1), F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


@pytest.mark.parametrize("cfg", [L.LmConfig(max_filter_bytes=1 << 16), L.LmConfig(max_filter_bytes=1 << 16, head_words=500)])
def test_filter_beyond_the_broadcast_bound_gives_the_same_scores(spark, cfg):
    """Many times more n-grams than fit ``max_filter_bytes``: not one score changes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted(map(tuple, L.score_documents(docs, held()).select("doc_id", "n_tokens", "score").collect()), key=str)
    got = sorted(map(tuple, L.score_documents(docs, held(), cfg=cfg).select("doc_id", "n_tokens", "score").collect()), key=str)
    assert len(got) == len(want) and [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want], rtol=1e-9)


def test_sliced_edge_cases(spark, stored):
    cfg = L.LmConfig(max_filter_bytes=0)
    df = stored([(i, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(5, "twice"), (5, "twice")], "doc_id long, text string")
    rows = [[(r.doc_id, r.n_tokens, round(r.score, 9)) for r in L.score_documents(df, held(), cfg=c).collect()] for c in (cfg, L.LmConfig())]
    assert sorted(rows[0]) == sorted(rows[1])
    assert L.score_documents(stored([], "doc_id long, text string", 1), held(), cfg=cfg).count() == 0


def test_levels_end_at_the_last_threshold():
    th = L.LmConfig().thresholds()
    h = np.arange(1, 100, dtype=np.uint64)
    level = L.probe(h, np.full(L.SEGMENT_BITS // 8, 255, np.uint8), 1)  # every bit set
    assert (level == len(th)).all()
    assert np.isfinite(L.decode(level + 5, th)).all()
