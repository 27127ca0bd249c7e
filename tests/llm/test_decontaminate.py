import collections
import random
import re

import pytest

from lexiflow.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def grams(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def brute(docs, items, threshold=0.8):
    out = {}
    for d, t in set(docs):
        w = words(t)
        for item, it in items:
            iw = words(it)
            if not iw or not w:
                continue
            k, size = min(5, len(iw)), len(iw)
            target = collections.Counter(grams(iw, k))
            at = {(max(0, min(i - j, len(w) - size))) for i, a in enumerate(grams(w, k)) for j, b in enumerate(grams(iw, k)) if a == b}
            for start in sorted(at):
                win = collections.Counter(grams(w[start:start + size], k))
                if not win:
                    continue
                both = sum((win & target).values())
                sim = both / (sum(win.values()) + sum(target.values()) - both)
                if sim >= threshold and sim > out.get((d, t, item), (0,))[0]:
                    out[(d, t, item)] = (sim, start, min(size, len(w) - start))
    return sorted((str(d), item, s, n, round(sim, 9)) for (d, _, item), (sim, s, n) in out.items())


def test_equals_brute_force(spark, stored):
    rnd = random.Random(4)
    v = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(v) for _ in range(rnd.randint(5, 60)))) for i in range(15)]
    items += [(20, "one two"), (21, "Solo"), (22, "x y x y x y x y x y"), (23, ""), (24, None), (25, items[0][1]), (26, "la " * 12)]
    docs = [(0, None), (1, ""), (2, "SOLO"), (3, "one two three"), (4, "x y x y x y x y x y x y"), (5, "la " * 11), (6, " \n ")]
    for i in range(60):
        _, it = items[rnd.randrange(15)]
        w = it.split()
        for _ in range(rnd.choice([0, 0, 1, 2, 5])):
            w[rnd.randrange(len(w))] = rnd.choice(v)
        if rnd.random() < 0.2:
            w = w[2:]
        pre, post = ([rnd.choice(v) for _ in range(rnd.choice([0, 3, 40]))] for _ in range(2))
        docs.append((rnd.choice([10 + i, None, 10]), " ".join(pre + w + post)))
    docs += [docs[9], docs[9]]
    df = stored(docs, "doc_id long, text string").selectExpr("*", "1 as th", "2 as item_id", "'s' as size")
    bench = stored(items, "item_id long, text string", 2).selectExpr("*", "3 as fp", "4 as sh")
    got = sorted((str(r.doc_id), r.item_id, r.start, r.n_words, round(r.similarity, 9)) for r in D.find_leaks(df, bench).collect())
    assert got == brute(docs, items)
    clean = collections.Counter(tuple(r) for r in D.clean_documents(df, bench).collect())
    bad = {(d, t) for d, t in docs if any(x[0] == str(d) for x in brute([(d, t)], items))}
    assert clean == collections.Counter((d, t, 1, 2, "s") for d, t in docs if (d, t) not in bad)


def test_blocks_find_everything_within_the_radius():
    rnd = random.Random(0)
    masks = D.block_masks()
    assert len(masks) == 37
    for _ in range(500):
        a = rnd.getrandbits(64)
        b = a
        for i in rnd.sample(range(64), D.RADIUS):
            b ^= 1 << i
        assert any(((a >> 8 * k) ^ (b >> 8 * k)) & 255 in masks for k in range(8))


def test_simhash_counts_bits(spark, stored):
    rnd = random.Random(2)
    rows = [(i, [rnd.getrandbits(64) - (1 << 63) for _ in range(n)]) for i, n in enumerate([1, 2, 3, 60, 400])]
    df = stored(rows, "k int, sh array<long>", 1)
    from pyspark.sql import functions as F
    for r in df.select("k", "sh", D.simhash(F.col("sh")).alias("fp")).collect():
        want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in r.sh) > len(r.sh))
        assert r.fp & (2**64 - 1) == want


@pytest.mark.parametrize("bench", [[], [(1, None)]])
def test_nothing_to_find(spark, stored, bench):
    docs = stored([(1, "a b c d e f")], "doc_id long, text string", 1)
    b = stored(bench, "item_id long, text string", 1)
    assert D.find_leaks(docs, b).count() == 0
    assert D.clean_documents(docs, b).count() == 1
    assert D.find_leaks(stored([], "doc_id long, text string", 1), stored([(1, "a b c d e f")], "item_id long, text string", 1)).count() == 0


def test_native(spark, stored):
    plan = D.find_leaks(stored([(1, "a b c d e f")], "doc_id long, text string", 1),
                        stored([(1, "a b c d e f")], "item_id long, text string", 1))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_numbered_tells_occurrences_apart(spark, stored):
    from pyspark.sql import functions as F
    rnd = random.Random(6)
    rows = [(i, [rnd.randrange(m) for _ in range(n)]) for i, (n, m) in enumerate(
        [(1, 1), (2, 1), (7, 2), (50, 5), (300, 1), (300, 40), (20, 10**9)])]
    df = stored(rows, "k int, sh array<long>", 1)
    got = {r.k: r.x for r in df.select("k", D.numbered(F.col("sh")).alias("x")).collect()}
    for k, sh in rows:
        assert len(set(got[k])) == len(sh) == len(got[k])
    pairs = df.select("k", "sh", F.transform("sh", lambda h: F.xxhash64(h, F.lit(0))).alias("first")).collect()
    for r in pairs:  # the first occurrence of each shingle is in, and equal multisets give equal sets
        assert set(r["first"]) <= set(got[r.k])
    shuffled = stored([(k, rnd.sample(sh, len(sh))) for k, sh in rows], "k int, sh array<long>", 1)
    ids = {r.k: set(r.x) for r in shuffled.select("k", D.numbered(F.col("sh")).alias("x")).collect()}
    assert ids == {k: set(x) for k, x in got.items()}


def test_texts_that_repeat_themselves(spark, stored):
    """The windows of a long repetitive text are told apart by their shingles."""
    items = [(1, "la " * 200), (2, "la " * 150), (3, "do re mi " * 60), (4, "fa so " * 20 + "la ti " * 20)]
    docs = [(1, "la " * 4000), (2, "do re mi " * 1500), (3, "fa so " * 300 + "la ti " * 300), (4, "la " * 140),
            (5, "ti do " * 2000), (1, "la " * 4000)]
    df = stored(docs, "doc_id long, text string")
    bench = stored(items, "item_id long, text string", 1)
    got = sorted((str(r.doc_id), r.item_id, r.start, r.n_words, round(r.similarity, 9)) for r in D.find_leaks(df, bench).collect())
    assert got == brute(docs, items)
    placed = spark.range(1).selectExpr("transform(sequence(0, 3999), i -> 7L) AS h",
                                       "transform(sequence(0, 3800), i -> struct(i AS start, 200 AS size)) AS w")
    from pyspark.sql import functions as F
    w = placed.select(D._distinct_windows(F.col("h"), F.col("w"), 5).alias("w")).first().w
    assert [(x.start, x.size, x.n_words, len(x.sh)) for x in w] == [(0, 200, 200, 196)]
