"""Cases outside the fixture: odd files, repeated and null ids, key values, small and large numbers."""

import json
import warnings

import pytest
from pyspark.sql import functions as F

from lexiflow import session as S
from lexiflow.functions import typo as TY
from lexiflow.operators import correct as CO
from lexiflow.operators import encode as EN
from lexiflow.operators import score as SC
from lexiflow.operators import split as SP
from lexiflow.operators.predict import Predictor
from lexiflow.sources import io as IO

CONFIG = {"correct_prompt": "fix:", "detect_prompt": "find:", "head_mark": "$", "tail_mark": "@"}


def test_prompt_config_of_any_layout(spark, tmp_path):
    for i, text in enumerate([json.dumps(CONFIG), json.dumps(CONFIG, indent=4)]):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        assert IO.read_prompt_config(spark, str(path)) == CONFIG
    for i, text in enumerate(["", "{", json.dumps({"head_mark": "$"})]):
        path = tmp_path / f"bad{i}.json"
        path.write_text(text)
        with pytest.raises(Exception):
            IO.read_prompt_config(spark, str(path))
    with pytest.raises(ValueError, match="no prompt config"):
        IO.read_prompt_config(spark, str(tmp_path / "none.json"))


def test_stop_words_path(spark, tmp_path):
    assert IO.read_stop_words(spark, None).count() == 0
    with pytest.raises(Exception):
        IO.read_stop_words(spark, str(tmp_path / "none")).count()


def test_single_line_csv_is_split(spark, tmp_path):
    df = spark.createDataFrame([(i, f"a, b {i}") for i in range(50)], "k long, t string")
    IO.write_csv(df.coalesce(1), str(tmp_path / "c"))
    got = IO.read_csv(spark, str(tmp_path / "c"), df.schema, multi_line=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("values,weights,want", [
    ([1e-7, 3e-7], [1, 1], 2e-7), ([2e12, 4e12], [1, 3], 3.5e12), ([1e300, 1e300], [1, 1], 1e300),
    ([0.1, 0.2, None], [1, 2, 5], 0.5 / 3), ([5.0, 1.0], [0.5, 1.5], 2.0), ([1e-7, 3.0], [1, 1], 1.50000005)])
def test_means_of_any_size(spark, values, weights, want):
    df = spark.createDataFrame([("g", i, v, float(w)) for i, (v, w) in enumerate(zip(values, weights))],
                               "g string, i long, v double, w double")
    assert SC.weighted_mean(df, "v", "w", ["g"]).first().weighted_mean == pytest.approx(want, rel=1e-9)
    last = SC.running_weighted_mean(df, "v", "w", "g", "i").orderBy(F.desc("i")).first()
    assert last.running_mean == pytest.approx(want, rel=1e-9)


def test_ids_may_repeat_or_be_null(spark):
    rows = [("a", "one two"), ("a", "three"), (None, "one"), (None, None), (None, "one"), ("b", "")]
    df = spark.createDataFrame(rows, "id string, t string")
    vocab = spark.createDataFrame([("one", 3, 3), ("two", 2, 4), ("three", 1, 5)], "word string, freq long, word_id long")
    got = sorted((str(r.id), str(r.t), tuple(r.ids)) for r in EN.encode_words(df, "id", "t", vocab).collect())
    want = {"one two": (3, 4), "three": (5,), "one": (3,), None: (), "": ()}
    assert got == sorted((str(i), str(t), want[t]) for i, t in rows)


def vocab(spark):
    return spark.createDataFrame([("receive", 9), ("please", 9), ("money", 9), ("home", 5)], "word string, freq long")


def test_correction_with_odd_ids(spark):
    rows = [(None, "please recieve"), ("a", "please recieve"), ("a", "monye home"), (None, None)]
    df = spark.createDataFrame(rows, "id string, t string")
    got = sorted((str(r.id), str(r.corrected)) for r in CO.correct_table(df, "id", "t", vocab(spark)).collect())
    assert got == sorted([("None", "please receive"), ("a", "please receive"), ("a", "money home"), ("None", "None")])


def test_join_distance_is_the_gate(spark):
    df = spark.createDataFrame([("a", "recxyeive")], "id string, t string")  # distance 2
    one = CO.correct_table(df, "id", "t", vocab(spark), CO.CorrectConfig(max_edit_distance=1)).first()
    two = CO.correct_table(df, "id", "t", vocab(spark), CO.CorrectConfig(max_edit_distance=2)).first()
    three = spark.createDataFrame([("a", "recxyzeive")], "id string, t string")
    far = CO.correct_table(three, "id", "t", vocab(spark), CO.CorrectConfig(max_edit_distance=3)).first()
    assert (one.corrected, two.corrected, far.corrected) == ("recxyeive", "receive", "receive")
    with pytest.raises(ValueError, match="max_edit_distance"):
        CO.correct_table(df, "id", "t", vocab(spark), CO.CorrectConfig(max_edit_distance=None))


class Marker(Predictor):
    def predict(self, texts):
        return [" ".join(f"$ {w} @" if w == "teh" else w for w in t.split(" ")[2:]) if t else None for t in texts]


class Fixer(Predictor):
    def predict(self, texts):
        return [" ".join("the" if w == "teh" else w for w in t.split(" ")[2:]) for t in texts]


def test_user_models(spark):
    rows = [(1, "teh cat and teh dog"), (1, "no error"), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "'x' as _clean", "1 as corrected_by")
    out = CO.correct_with_models(df, "text", Marker, Fixer)
    got = sorted((str(r.id), str(r.corrected)) for r in out.collect())
    assert got == sorted([("1", "the cat and the dog"), ("1", "no error"), ("None", "None"), ("2", "")])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    gated = CO.correct_with_models(df, "text", Marker, Fixer, CO.CorrectConfig(max_edit_distance=1))
    assert {r.corrected for r in gated.collect()} >= {"teh cat and teh dog"}


@pytest.mark.parametrize("key", ["xxhash64(id)", "0L", "id"])
def test_kfold_whatever_the_keys(spark, key):
    df = spark.range(4000).selectExpr(f"{key} as k", "id as k2", "if(id % 3 = 0, 'a', concat('c', id % 5)) as cls")
    got = SP.stratified_kfold(df, "cls", ["k", "k2"], 10, n_partitions=16)
    rows = sorted(got.collect(), key=lambda r: (r.k, r.k2))
    first = {}
    for r in rows:
        first.setdefault(r.cls, len(first))
    order = sorted(range(len(rows)), key=lambda i: (first[rows[i].cls], i))
    quota = {}
    for j, i in enumerate(order):
        quota.setdefault(rows[i].cls, [0] * 10)[j % 10] += 1
    seen = dict.fromkeys(quota, 0)
    for r in rows:
        rank, fold = seen[r.cls], 0
        while rank >= quota[r.cls][fold]:
            rank -= quota[r.cls][fold]
            fold += 1
        assert r.fold == fold
        seen[r.cls] += 1
    sizes = [r["count"] for r in df.repartitionByRange(16, "cls", "k", "k2").groupBy(F.spark_partition_id(), "cls").count().collect()]
    assert max(sizes) < 4000 / 16 * 3  # no window group grows with a class or a key


def test_small_classes_warn(spark):
    df = spark.createDataFrame([(i, "big") for i in range(30)] + [(99, "small")], "k long, cls string")
    with pytest.warns(UserWarning, match="1 classes"):
        SP.stratified_kfold(df, "cls", ["k"], 10)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        SP.stratified_kfold(df.where("cls = 'big'"), "cls", ["k"], 10)


def test_typos_of_one_letter_words_never_fail(spark):
    t = TY.generate_typo(F.col("w"), 2330, F.md5("w"), F.lit(0), F.col("id"))
    df = spark.range(300_000).select(F.lit("aaaa").alias("w"), "id")
    r = df.select(t.alias("t"), "w").agg(F.count(F.when(F.col("t") == F.col("w"), 1)).alias("same"), F.count("t").alias("n")).first()
    assert (r.same, r.n) == (0, 300_000)


def test_scratch_names_are_unique(spark):
    a, b = S.scratch_path(spark, "x"), S.scratch_path(spark, "x")
    assert a != b and spark.sparkContext.applicationId in a
    spark.range(1).write.parquet(a)
    S.remove_path(spark, a)
    with pytest.raises(Exception):
        spark.read.parquet(a)


def test_scope_leaves_nothing(spark):
    with S.scratch_scope(spark):
        df = S.write_table(spark.range(3), "gone")
        path = df.inputFiles()[0]
        assert df.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_label_files(spark, tmp_path):
    from lexiflow.operators import label as L

    lines = tmp_path / "lines.txt"
    lines.write_text("plain words everywhere\nstopped words everywhere\n")
    stop = tmp_path / "stop.txt"
    stop.write_text("plain\nwords\neverywhere\nstopped\n")
    cfg = L.LabelConfig(typo_probability=1.0)
    some = L.label_files(spark, str(lines), str(tmp_path / "a"), str(tmp_path / "ca"), cfg)
    none = L.label_files(spark, str(lines), str(tmp_path / "b"), str(tmp_path / "cb"), cfg, str(stop))
    assert some.where("input like 'correct%'").count() == 8 and none.count() == 2  # no word left to change
    assert IO.read_prompt_config(spark, str(tmp_path / "cb")) == cfg.prompt_config()


def test_scores_with_a_user_model(spark):
    rows = [(1, 0, "detect typo: a b", "a b", "x"), (2, 1, "correct typo: a c", "a b", "y")]
    df = spark.createDataFrame(rows, "id long, task int, input string, output string, extra string")
    voc = spark.createDataFrame([("a", 3, 3), ("b", 2, 4), ("c", 1, 5)], "word string, freq long, word_id long")
    from lexiflow.operators.predict import StripPromptPredictor

    out = SC.score_test_set(df, "id", voc, predictor=lambda: StripPromptPredictor(2))
    assert {(r.id, r.extra, r.prediction, r.correct) for r in out.collect()} == {(1, "x", "a b", True), (2, "y", "a c", False)}
    assert SC.evaluate_dataset(df, "id", voc, predictor=lambda: StripPromptPredictor(2)).first().accuracy == 0.5


def test_union_keeps_duplicates(spark):
    from lexiflow.operators import label as L

    a = spark.createDataFrame([(1, "x"), (1, "x")], "k long, t string")
    assert L.union_rows(a, a.select("t", "k")).count() == 4


def test_default_looks_for_candidates_at_distance_3(spark):
    rows = [("a", "recxyzeive"), ("b", "plse"), ("c", "reecaive"), ("d", "recxyzweive")]  # distances 3, 2, 3, 4
    df = spark.createDataFrame(rows, "id string, t string")
    got = {r.id: r.corrected for r in CO.correct_table(df, "id", "t", vocab(spark)).collect()}
    assert got == {"a": "receive", "b": "please", "c": "receive", "d": "recxyzweive"}
