"""Marks in the text, classes that are null, sizes of nested columns, the stored key index."""

import glob
import os
import time

from pyspark.sql import functions as F

from lexiflow.functions import correct as FC
from lexiflow.operators import correct as CO
from lexiflow.operators import split as SP
from lexiflow.session import broadcast_if_small, scratch_path
from lexiflow.streaming import correct_stream as CS

VOCAB = [("money", 9), ("home", 9), ("receive", 9), ("spelling", 9), ("word", 9)]


def vocab(spark):
    return spark.createDataFrame(VOCAB, "word string, freq long")


def test_text_with_marks_is_corrected(spark):
    rows = [(1, "pay 5 $ monye @ homee recieve"), (2, "$ @ $"), (3, "speling $ wordd"), (4, "no marks monye"), (5, ""), (6, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {r.id: r.corrected for r in CO.correct_table(df, "id", "text", vocab(spark)).collect()}
    assert got == {1: "pay 5 $ money @ home receive", 2: "$ @ $", 3: "spelling $ word", 4: "no marks money", 5: "", 6: None}


def test_pair_mode_still_parses_marks(spark):
    df = spark.createDataFrame([(1, "speling of monye")], "id long, text string")
    cfg = CO.CorrectConfig(locate_mode="pair")
    assert CO.correct_table(df, "id", "text", vocab(spark), cfg).first().corrected == "spelling of money"


def in_turn(words, idx, fixes, most):
    from tests.test_edit_fuzzy import py_distance

    words = list(words)
    for i, c in zip(idx, fixes):
        if 0 <= i < len(words) and (most is None or py_distance(words[i], c) <= most):
            words[i] = c
    return words


def test_apply_corrections_in_one_pass_and_in_turn(spark):
    words = ["aa", "bb", "cc", "dd"]
    cases = [([], []), ([0], ["ab"]), ([0, 1, 3], ["ab", "zzzz", "d"]), ([3], ["x"]), ([1, 1], ["bc", "cc"]), ([2, 0], ["c", "a"]),
             ([0, 1], ["a"]), ([0], ["a", "b"]), ([1, 9], ["b", "x"]), ([0, 1, 2, 3], ["a", "b", "c", "d"])]
    df = spark.createDataFrame([(k, words, i, c) for k, (i, c) in enumerate(cases)], "k int, w array<string>, i array<int>, c array<string>")
    for most in (2, None):
        out = df.select("k", FC.apply_corrections(F.col("w"), F.col("i"), F.col("c"), most).alias("o")).collect()
        assert {r.k: r.o for r in out} == {k: in_turn(words, i, c, most) for k, (i, c) in enumerate(cases)}


def test_null_class_is_a_class(spark):
    rows = [(i, [None, "a", "b", None, "a"][i % 5]) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, c string")
    got = SP.stratified_kfold(df, "c", ["k"], 5)
    named = df.withColumn("c", F.coalesce("c", F.lit("zz")))
    want = SP.stratified_kfold(named, "c", ["k"], 5)
    assert sorted((r.k, r.fold) for r in got.collect()) == sorted((r.k, r.fold) for r in want.collect())
    assert got.count() == 50


def test_broadcast_counts_nested_columns(spark):
    big = spark.range(20).select(F.array_repeat(F.col("id"), 10_000).alias("a"))
    nested = spark.range(20).select(F.struct(F.array(F.repeat(F.lit("x"), 100_000)).alias("s")).alias("t"))
    binary = spark.range(20).select(F.repeat(F.lit("x"), 100_000).cast("binary").alias("b"), F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    for df in (big, nested, binary):
        assert broadcast_if_small(df, max_bytes=1_000_000) is df
        assert broadcast_if_small(df) is not df


def _conversations(spark, n):
    rows = [(i, ["speling of monye", "homee wordd", "recieve"][i % 3]) for i in range(n)]
    path = scratch_path(spark, "src")
    spark.createDataFrame(rows, "id long, text string").repartition(3).write.parquet(path)
    return path, rows


def test_micro_batch_does_not_shuffle_the_index(spark):
    index = CO.vocabulary_index(vocab(spark), CO.CorrectConfig())
    kept = CS.bucketed_index(index, scratch_path(spark, "keys"))
    words = spark.createDataFrame([("monye",), ("homee",)], "word string")
    df = CO.nearest_known(words, "word", kept, 3)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("ShuffledHashJoin"):].split("\n")
    table = next(i for i, line in enumerate(join) if "Scan parquet" in line and "lexiflow_keys" in line)
    # between the join and the scan of the index: neither an exchange nor a sort on its side
    depth = len(join[table]) - len(join[table].lstrip(" :+-|*()0123456789"))
    above = [x for x in join[:table] if len(x) - len(x.lstrip(" :+-|*()0123456789")) < depth]
    side = join[max(i for i, x in enumerate(join[:table]) if x in above and "Exchange" not in x and "Sort" not in x):table + 1]
    assert not any("Exchange" in x or "Sort" in x for x in side) and "Bucketed: true" in join[table]
    assert {tuple(r) for r in df.collect()} == {("monye", "money", 2), ("homee", "home", 1)}


def test_stream_with_a_processing_time_trigger_and_another_source(spark):
    path, rows = _conversations(spark, 30)
    text = scratch_path(spark, "json-src")
    spark.read.parquet(path).repartition(2).write.json(text)
    sink = scratch_path(spark, "sink")
    q = CS.stream_correct(spark, text, spark.read.parquet(path).schema, "id", "text", vocab(spark), sink, scratch_path(spark, "ck"),
                          source_format="json", options={"maxFilesPerTrigger": "1"}, trigger={"processingTime": "1 second"}, wait=False)
    try:
        for _ in range(120):
            done = glob.glob(os.path.join(sink, "epoch=*", "_SUCCESS"))
            if len(done) >= 2 or not q.isActive:
                break
            time.sleep(1)
        assert q.isActive
        spark.createDataFrame([(99, "speling")], "id long, text string").write.mode("append").json(text)  # it keeps running
        for _ in range(120):
            if len(glob.glob(os.path.join(sink, "epoch=*", "_SUCCESS"))) >= 3:
                break
            time.sleep(1)
    finally:
        q.stop()
    fixed = {"speling of monye": "spelling of money", "homee wordd": "home word", "recieve": "receive", "speling": "spelling"}
    got = {r.id: r.corrected for r in spark.read.parquet(sink).collect()}
    assert got == {i: fixed[t] for i, t in [*rows, (99, "speling")]}
