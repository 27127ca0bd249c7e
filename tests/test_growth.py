"""Work that grew faster than the input, or more copies of the rows on disk than the job needs."""

import os
import random
import time

from pyspark.sql import functions as F

from lexiflow.functions import edit as ED
from lexiflow.functions import typo as TY
from lexiflow.operators import correct as CO
from lexiflow.operators import encode as EN
from lexiflow.operators import label as L
from lexiflow.operators import split as SP
from lexiflow.plans import catalog as C
from lexiflow.session import scratch_path
from tests.test_edit_fuzzy import py_distance


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_sentence_is_split_once_not_once_per_word(spark):
    df = spark.createDataFrame([("some words of a sentence .",)], "sentence string")
    chosen = L.plan_typos(df, "sentence", C.LABEL).where(F.col("_chosen").isNotNull())
    marked = chosen.select("sentence", TY.mark_words(F.col("_words"), F.col("_chosen"), "$", "@").alias("m"))
    for plan in (optimized(chosen.select("sentence", F.size("_chosen"))), optimized(marked)):
        assert plan.count("split(") <= 2  # in the filter and in the projection
        assert "RLIKE(split(" not in plan and "array_contains(CASE" not in plan


def test_marks_of_a_long_sentence(spark):
    words = [f"word{'abcdefghij'[i % 10]}" for i in range(20_000)]
    df = spark.createDataFrame([(" ".join([*words, str(i)]),) for i in range(16)], "sentence string")
    begun = time.time()
    planned = L.plan_typos(df, "sentence", C.LABEL).where(F.col("_chosen").isNotNull())
    got = planned.select(F.size("_chosen").alias("n"), TY.mark_words(F.col("_words"), F.col("_chosen"), "$", "@").alias("m"), "_words").collect()
    assert time.time() - begun < 60
    assert got and all(sum(a != b for a, b in zip(r.m, r["_words"])) == r.n for r in got)


def test_distance_of_near_words_needs_no_table(spark):
    rnd = random.Random(8)
    w = "".join(rnd.choice("abcde") for _ in range(2500))
    pairs = [(w, w[:9] + w[10:], 1), (w, w[:900] + "x" + w[901:], 2), (w[:700] + "xy" + w[700:], w[:700] + "yx" + w[700:], 2), (w, w, 0), ("", w, 2500)]
    df = spark.createDataFrame(pairs, "a string, b string, d int")
    begun = time.time()
    assert [r[0] for r in df.select(ED.edit_distance(F.col("a"), F.col("b"))).collect()] == [d for _, _, d in pairs]
    assert time.time() - begun < 60


def test_distance_equals_the_table(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abé") for _ in range(rnd.randrange(7)))
    pairs = [(word(), word()) for _ in range(300)] + [(None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(ED.edit_distance(F.col("a"), F.col("b"))).collect()]
    assert got == [None if a is None or b is None else py_distance(a, b) for a, b in pairs]


def test_encoding_moves_the_rows_once(spark):
    rows = [(i % 7 if i % 5 else None, f"a b{i % 3} zz  a", None if i % 6 == 0 else f"b{i % 3}", "s") for i in range(60)] + [(1, "", "", None)] * 3
    df = spark.createDataFrame(rows, "id int, input string, output string, split string")
    vocab = spark.createDataFrame([("a", 3), ("b0", 4), ("b1", 5)], "word string, word_id long")
    out = EN.encode_dataset(df, "id", vocab, 6)
    plan = out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    ids = {"a": 3, "b0": 4, "b1": 5}

    def coded(t):
        return [*[ids.get(w, 2) for w in (t or "").split(" ") if w][:5], 1]

    def row(i, a, b, s):
        x, y = coded(a), coded(b)
        return (str(i), s, x + [0] * (6 - len(x)), [1] * len(x) + [0] * (6 - len(x)), y + [-100] * (6 - len(y)))

    got = sorted(map(str, ((str(r.id), r.split, r.input_ids, r.attention_mask, r.labels) for r in out.collect())))
    assert got == sorted(str(row(*r)) for r in rows)


def test_longest_padding_does_not_move_the_rows(spark):
    df = spark.createDataFrame([(i, list(range(3, 3 + i % 5)), [3] * (i % 3)) for i in range(50)], "id int, a array<long>, b array<long>")
    out = EN.encode_longest(df, "a", "b", [F.col("id")], 10)
    assert "Window [max(" not in optimized(out)
    for r in out.collect():
        batch = range(r.batch * 10, r.batch * 10 + 10)
        assert len(r.input_ids) == len(r.attention_mask) == 1 + max(i % 5 for i in batch) and len(r.labels) == 1 + max(i % 3 for i in batch)


def test_folds_need_no_window_over_the_rows(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "x" * 50) for i in range(100)], "k int, c string, text string")
    out = SP.stratified_kfold(df, "c", ["k"], 5)
    assert "row_number" not in optimized(out)
    got = {r.k: r.fold for r in out.collect()}
    assert got == {i: (i // 2) // 10 for i in range(100)}


def test_words_with_a_near_candidate_are_not_looked_up_farther(spark, monkeypatch):
    vocab = spark.createDataFrame([("spelling", 9), ("money", 9), ("receive", 5), ("deceive", 7)], "word string, freq long")
    left = spark.createDataFrame([("speling",), ("monye",), ("speeelling",), ("xeceive",), ("qqqqqq",), ("spellingxyz",)], "word string")
    asked, real = {}, CO._key_matches

    def recorded(words, col, index, distance, *rest):
        asked[distance] = sorted(r[0] for r in words.select(col).collect())
        return real(words, col, index, distance, *rest)

    monkeypatch.setattr(CO, "_key_matches", recorded)
    got = {tuple(r) for r in CO.nearest_known(left, "word", CO.candidate_index(vocab, 3), 3).collect()}
    assert got == {("speling", "spelling", 1), ("monye", "money", 2), ("speeelling", "spelling", 2), ("xeceive", "deceive", 2), ("spellingxyz", "spelling", 3)}
    assert asked[1] == sorted(r[0] for r in left.collect())
    assert "speling" not in asked[2] and asked[3] == ["qqqqqq", "spellingxyz"]


def test_the_best_of_pairs_is_found_where_they_are(spark):
    vocab = spark.createDataFrame([("abcd", 3), ("abce", 4)], "word string, freq long")
    pairs = spark.createDataFrame([("abc", "abcd", 1), ("abc", "abce", 1)], "word string, cand string, distance int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        best = CO.best_candidate(pairs, "word", "cand", vocab)
        assert "SortMergeJoin" not in best._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r) for r in best.collect()] == [("abc", "abce", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_stream_over_a_folder_of_files(spark, sf_dir):
    folder = scratch_path(spark, "tables").removeprefix("file:")
    os.makedirs(folder)
    for name in os.listdir(sf_dir):
        if name != "conversations.parquet":
            os.symlink(f"{sf_dir}/{name}", f"{folder}/{name}")
    spark.read.parquet(f"{sf_dir}/conversations.parquet").limit(40).repartition(2).write.parquet(f"{folder}/conversations.parquet")
    got = C.QUERIES["stream_correct"](spark, folder)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, C.QUERIES["correct_text"](spark, folder).collect()))
    assert got.count() == 40
