"""Edit distance, the gate and the fuzzy join against brute force."""

import random

from pyspark.sql import functions as F

from lexiflow.functions import edit as ED
from lexiflow.operators import correct as CO


def py_distance(a, b):
    """insert 1, delete 1, substitute 2, by the textbook table."""
    m = [[i + j for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            sub = 0 if a[i - 1] == b[j - 1] else 2
            m[i][j] = min(m[i - 1][j] + 1, m[i][j - 1] + 1, m[i - 1][j - 1] + sub)
    return m[len(a)][len(b)]


def _pairs(n=300, seed=7):
    rnd = random.Random(seed)
    out = [("", ""), ("", "abc"), ("abc", ""), ("kitten", "sitting")]
    for _ in range(n):
        a = "".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 8)))
        b = "".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 8)))
        out.append((a, b))
    return out


def test_edit_distance_matches_dp(spark):
    pairs = _pairs()
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(ED.edit_distance(F.col("a"), F.col("b"))).collect()]
    assert got == [py_distance(a, b) for a, b in pairs]


def test_gate_matches_dp(spark):
    pairs = _pairs(seed=11)
    df = spark.createDataFrame(pairs, "a string, b string")
    for mx in (0, 1, 2, 3, 5):
        got = [r[0] for r in df.select(ED.within_distance(F.col("a"), F.col("b"), mx)).collect()]
        assert got == [py_distance(a, b) <= mx for a, b in pairs]


def test_fuzzy_join_equals_brute_force(spark, sf_dir):
    """On a small fixture of real words: every pair within D, nothing else."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = (docs.select(F.explode(F.split("text", "[^A-Za-z]+")).alias("w"))
             .where(F.length("w") >= 3).distinct().orderBy("w").limit(400))
    ws = [r[0] for r in words.collect()]
    left = spark.createDataFrame([(w,) for w in ws[::3]], "word string")
    right = spark.createDataFrame([(w,) for w in ws], "word string")
    for d in (1, 2):
        got = {(r[0], r[1], r[2]) for r in CO.fuzzy_vocab_join(left, "word", right, "word", d).collect()}
        want = {(a, b, py_distance(a, b)) for a in ws[::3] for b in ws if py_distance(a, b) <= d}
        assert got == want


def test_fuzzy_join_plan_has_no_pairwise_join(spark):
    left = spark.createDataFrame([("abcd",)], "word string")
    plan = CO.fuzzy_vocab_join(left, "word", left, "word", 2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_nearest_known_equals_brute_force(spark, sf_dir):
    """J2 + W3 fused: per word the closest, then most frequent, then smallest
    vocabulary word, as picked by brute force."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = (docs.select(F.explode(F.split("text", "[^A-Za-z]+")).alias("w"))
             .where(F.length("w") >= 3).distinct().orderBy("w").limit(400))
    ws = [r[0] for r in words.collect()]
    freq = {w: 1 + (i * 7) % 5 for i, w in enumerate(ws)}
    left = spark.createDataFrame([(w + "x",) for w in ws[::4]] + [(w[1:],) for w in ws[1::4]], "word string")
    vocab = spark.createDataFrame(list(freq.items()), "word string, freq long")
    index = CO.candidate_index(vocab, 2)
    got = {r[0]: (r[1], r[2]) for r in CO.nearest_known(left, "word", index, 2).collect()}
    want = {}
    for (a,) in left.collect():
        cands = [(py_distance(a, b), -freq[b], b) for b in ws if py_distance(a, b) <= 2]
        if cands:
            d, _, b = min(cands)
            want[a] = (b, d)
    assert got == want


def test_bounded_distance_matches_dp(spark):
    pairs = _pairs(seed=13)
    df = spark.createDataFrame(pairs, "a string, b string")
    for most in (0, 1, 2, 3, 4, 5, 7):
        got = [r[0] for r in df.select(ED.bounded_distance(F.col("a"), F.col("b"), most)).collect()]
        assert got == [d if (d := py_distance(a, b)) <= most else None for a, b in pairs]


def _edited(rnd, w, edits):
    for _ in range(edits):
        i = rnd.randrange(len(w))
        w = w[:i] + w[i + 1:] if rnd.random() < 0.5 else w[:i] + rnd.choice("abc\u00e9") + w[i:]
    return w


def test_fuzzy_join_of_long_words_equals_brute_force(spark):
    """Lengths around the bound, and 300 letters: every pair within 3, nothing else."""
    rnd = random.Random(3)
    right = ["".join(rnd.choice("abc\u00e9") for _ in range(n)) for n in (26, 28, 29, 30, 31, 32, 33, 34, 35, 36, 60, 300)]
    right += ["a" * 31, "a" * 34, "ab" * 17, "ab" * 18]
    left = sorted({_edited(rnd, w, e) for w in right for e in (0, 1, 2, 3, 4) for _ in range(2)})
    ldf, rdf = (spark.createDataFrame([(w,) for w in x], "word string") for x in (left, right))
    got = {tuple(r) for r in CO.fuzzy_vocab_join(ldf, "word", rdf, "word", 3).collect()}
    want = {(a, b, d) for a in left for b in right if abs(len(a) - len(b)) <= 3 and (d := py_distance(a, b)) <= 3}
    assert got == want and len(want) > 60


def test_fuzzy_join_of_5000_letters(spark):
    rnd = random.Random(4)
    w = "".join(rnd.choice("abcde") for _ in range(5000))
    far = "".join(rnd.choice("abcde") for _ in range(5000))
    left = {w[:9] + w[10:]: 1, w[:2500] + "x" + w[2501:]: 2, w[1:-1] + "xx": 4, w + "xyz": 3}
    rdf = spark.createDataFrame([(w,), (far,)], "word string")
    ldf = spark.createDataFrame([(x,) for x in left], "word string")
    got = {(r[0], r[2]) for r in CO.fuzzy_vocab_join(ldf, "word", rdf, "word", 3).collect()}
    assert got == {(x, d) for x, d in left.items() if d <= 3}


def test_words_within_the_distance_share_a_key(spark):
    """Every pair within D, of 1 to 300 letters, shares a key (not only those that other keys find)."""
    rnd = random.Random(5)
    pairs = []
    for _ in range(600):
        a = "".join(rnd.choice("ab\u00e9") for _ in range(rnd.choice([1, 2, 3, 4, 5, 7, 8, 9, 10, 12, 40, 300])))
        b = a
        for _ in range(rnd.randint(0, 3)):
            if b:
                b = _edited(rnd, b, 1)
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    for d in (1, 2, 3):
        for letters in (CO.key_letters, lambda x, y: 1):
            hit = F.arrays_overlap(CO.prefix_keys(F.col("a"), d, True, letters), CO.prefix_keys(F.col("b"), d, False, letters))
            got = [r[0] for r in df.select(hit).collect()]
            assert all(g for g, (a, b) in zip(got, pairs) if py_distance(a, b) <= d)
    keys = [F.size(CO.prefix_keys(F.lit("abcdefghijklmnopqrstuvwxyz"), 3, left)) for left in (True, False)]
    assert tuple(spark.range(1).select(*keys).first()) == (129, 129)


def test_fuzzy_join_of_random_words_equals_brute_force(spark):
    """Words of one to 300 letters around both kinds of keys."""
    rnd = random.Random(9)
    right = sorted({"".join(rnd.choice("abc") for _ in range(rnd.choice([1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 31, 33, 300]))) for _ in range(120)})
    left = sorted({_edited(rnd, w, rnd.randint(0, 3)) for w in right if len(w) > 3} | set(right[::3]) | {""})
    ldf, rdf = (spark.createDataFrame([(w,) for w in x], "word string") for x in (left, right))
    got = {tuple(r) for r in CO.fuzzy_vocab_join(ldf, "word", rdf, "word", 3).collect()}
    assert got == {(a, b, d) for a in left for b in right if abs(len(a) - len(b)) <= 3 and (d := py_distance(a, b)) <= 3}


def test_best_candidate_is_a_hash_aggregate(spark):
    vocab = spark.createDataFrame([("abcd", 3), ("abce", 3), ("abcf", 1), ("zzzz", 9)], "word string, freq long")
    left = spark.createDataFrame([("abcg",), ("abc",), ("qqqqqqq",)], "word string")
    near = CO.nearest_known(left, "word", CO.candidate_index(vocab, 3), 3)
    pairs = CO.fuzzy_vocab_join(left, "word", vocab, "word", 3, "cand")
    best = CO.best_candidate(pairs, "word", "cand", vocab)
    for df in (near, best):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in df.collect()} == {("abcg", "abcd", 2), ("abc", "abcd", 1)}
