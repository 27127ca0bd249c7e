"""Token ids looked up where the row is: the same rows as the regroup, and no exchange."""

import os
import random

import pyarrow as pa
from pyspark.sql import functions as F

from lexiflow.operators import correct as CO
from lexiflow.operators import encode as EN
from lexiflow.operators import score as SC
from lexiflow.plans import catalog as C
from lexiflow.session import scratch_path, write_table


def _vocab(spark, words):
    return spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, word_id long")


def _texts(spark):
    rnd = random.Random(4)
    words = ["a", "b", "é", "zz", "", "\t", "日本", "a\n", "unknown", "$"]
    rows = [(i % 9 if i % 4 else None, " ".join(rnd.choice(words) for _ in range(rnd.randrange(200 if i % 50 == 0 else 9))),
             None if i % 6 == 0 else rnd.choice(words), "s") for i in range(300)]
    return spark.createDataFrame(rows + [(1, "", "", None)] * 3, "id int, input string, output string, split string")


def test_index_gives_the_rows_of_the_regroup(spark):
    df, vocab = _texts(spark), _vocab(spark, ["a", "b", "é", "zz", "\t", "日本", "a\n", None])
    index = EN.word_index(vocab)
    cols = {"input": "i", "output": "o"}
    for way in (lambda *more: EN.encode_texts(df, cols, vocab, *more), lambda *more: EN.encode_columns(df, "id", cols, vocab, *more),
                lambda *more: EN.encode_dataset(df, "id", vocab, 6, *more)):
        by_index, regrouped = way(index), way()
        assert by_index.columns == regrouped.columns
        assert sorted(map(repr, by_index.collect())) == sorted(map(repr, regrouped.collect()))
        assert "Exchange" not in by_index._jdf.queryExecution().executedPlan().toString()


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(EN, "_hashes", lambda words: pa.compute.binary_length(words).to_numpy().astype("uint64") % 2)
    words = [b"a", b"bb", b"c", b"dd", b"e"]
    index = EN.WordIndex(pa.array(words), pa.array([3, 4, 5, 6, 7]).to_numpy())
    assert index.look_up(pa.array([b"e", b"x", b"a", b"dd", b"yy", b"c"])).tolist() == [7, 2, 3, 6, 2, 5]
    assert index.encode(pa.array(["skip", None, "e  dd", "", "x a "]).slice(1)).to_pylist() == [[], [7, 6], [], [2, 3]]


def test_large_or_repeated_words_are_joined(spark):
    vocab = _vocab(spark, ["a", "b", "b"])
    assert EN.word_index(vocab) is None
    assert EN.word_index(_vocab(spark, ["a", "b"]), max_bytes=41) is None
    assert EN.word_index(_vocab(spark, ["a", "b"]), max_bytes=42) is not None
    assert EN.word_index(_vocab(spark, [])) is not None


def test_encoding_queries_move_no_row(spark, sf_dir):
    for name in ("vocab_encode_join", "encode_fixed", "encode_dataset"):
        plan = C.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
        assert "Exchange" not in plan


def test_fixed_rows(spark):
    df = spark.createDataFrame([([5, 6], [7]), ([5, 6, 7, 8, 9], []), ([], [4, 4, 4, 4])], "a array<bigint>, b array<bigint>")
    got = [tuple(r) for r in EN.encode_fixed(df, "a", "b", 4).collect()]
    assert got == [([5, 6, 1, 0], [1, 1, 1, 0], [7, 1, -100, -100]), ([5, 6, 7, 1], [1, 1, 1, 1], [1, -100, -100, -100]),
                   ([1, 0, 0, 0], [1, 0, 0, 0], [4, 4, 4, 1])]


def test_a_written_step_leaves_no_shuffle(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return sum(name.startswith("shuffle_") for d in folders for _, _, names in os.walk(d) for name in names)

    before = shuffles()
    write_table(spark.range(20_000).groupBy((F.col("id") % 999).alias("k")).agg(F.max("id")), "step")
    assert shuffles() <= before


def test_scoring_shuffles_no_tokens(spark):
    vocab = spark.createDataFrame([("a", 3, 9), ("b", 4, 9), ("spelling", 5, 9)], "word string, word_id long, freq long")
    rows = [(1, "detect typo: a b speling", 0, "a b $ speling @"), (2, "correct typo: x $ speling @", 1, "x $ spelling @"), (3, "detect typo: a", 0, "b")]
    df = spark.createDataFrame(rows, "id int, input string, task int, output string")
    scored = SC.score_test_set(df, "id", vocab)

    def moves(d):
        return d._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_COL")

    assert moves(scored) == moves(SC.vocab_predict(df, "id", "input", "task", vocab))
    assert {r.id: r.correct for r in scored.collect()} == {1: True, 2: True, 3: False}
    # aggregated, the optimiser merges what makes the predictions with what reads their ids
    assert tuple(SC.accuracy(scored).first())[:2] == (3, 2)


def test_near_keys_tell_words_that_begin_alike(spark):
    rnd = random.Random(8)
    words = sorted({"begin" + "".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(60)})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for d in (1, 2):
        left = df.select(F.col("w").alias("l"), F.explode(CO.prefix_keys(F.col("w"), d, True)).alias("k"))
        right = df.select(F.col("w").alias("r"), F.explode(CO.prefix_keys(F.col("w"), d, False)).alias("k"))
        met = left.join(right, "k").where("l <> r").select("l", "r").distinct().count()
        assert met < len(words) ** 2 / 5  # nearly all with keys of 5 letters
