"""Labelling and cleaning without lambdas over all words, k-fold by the first rows of folds."""

import pytest
from pyspark.sql import functions as F

from lexiflow.functions import text as T
from lexiflow.functions import typo as TY
from lexiflow.operators import label as L
from lexiflow.operators import split as SP

SENTENCES = ["the lungs are clear .", " there  are blanks  here ", "one", "word , another ( third ) fourth .", "ÿes naïve plain",
             "aaaa bbbb cccc dddd eeee ffff gggg", "    ", "oooo"]


def test_unrolled_typos_equal_lambda_typos(spark, monkeypatch):
    df = spark.createDataFrame([(s,) for s in SENTENCES * 3], "sentence string")
    cfg = L.LabelConfig(typo_probability=1.0, seed=7)
    want = sorted(map(tuple, L.label_rows(df, cfg=cfg, with_id=True).collect()))
    monkeypatch.setattr(L, "UNROLLED_TYPOS", 0)
    assert sorted(map(tuple, L.label_rows(df, cfg=cfg, with_id=True).collect())) == want


def test_copies_do_not_go_over_all_words(spark):
    df = spark.createDataFrame([(s,) for s in SENTENCES], "sentence string")
    plan = L.label_rows(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan


@pytest.mark.parametrize("at", [[0], [2], [0, 1], [1, 3], [0, 3], [0, 1, 2, 3]])
def test_gaps_hold_all_but_the_words(spark, at):
    words = ["a", "", "b", "c"]
    df = spark.createDataFrame([(words, at)], "ws array<string>, at array<int>")
    own = F.transform("at", lambda i: F.get("ws", i))
    between = TY.gaps(F.col("ws"), F.col("at"))
    plain, marked = df.select(TY.fill_gaps(between, own), TY.fill_gaps(between, own, "$ ", " @")).first()
    assert plain == " ".join(words)
    assert marked == " ".join(f"$ {w} @" if i in at else w for i, w in enumerate(words))


def test_cleaning_rules_on_odd_spaces(spark):
    odd = ["", " ", "\t", " a", "a ", " \ta b  ", "a  b\n\nc", " x y ", "a\x1cb", "a \x85 b", "x .\n", "​a ", "é  　é", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string")
    t = F.col("t")
    run = T.SPACE_RUN
    old_clean = F.regexp_replace(t, "\n", " ")
    old_clean = F.regexp_replace(old_clean, "([" + T._escape_class(T.PAD_PUNCTUATION) + "])", " $1 ")
    old_clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(old_clean, T._PERIOD_PATTERN_JAVA, " ."), run, " "), "^ | \\z", "")
    for new, old in ((T.typeset_clean(t), old_clean), (T.strip_space(t), F.regexp_replace(t, T.STRIP_PATTERN, "")),
                     (T.content_key(t), F.regexp_replace(t, run, ""))):
        assert [r.n for r in df.orderBy("i").select(new.alias("n")).collect()] == [r.o for r in df.orderBy("i").select(old.alias("o")).collect()]


def test_kfold_shuffles_keys_alone_and_ties_keep_quotas(spark):
    rows = [(k, [None, "a", "b"][k % 3], f"text {k}") for k in range(47)]
    df = spark.createDataFrame(rows, "k long, c string, t string")
    got = SP.stratified_kfold(df, "c", ["k"], 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "ordered" not in plan and "fold-starts" in plan
    sizes = sorted(r["count"] for r in got.groupBy("c", "fold").count().collect())
    tied = SP.stratified_kfold(df.withColumn("k", F.lit(1)), "c", ["k"], 5)
    assert sorted(r["count"] for r in tied.groupBy("c", "fold").count().collect()) == sizes and tied.count() == 47
    small = spark.createDataFrame([(k, "abcd"[min(k, 3)]) for k in range(12)], "k long, c string")
    with pytest.warns(UserWarning):
        few = SP.stratified_kfold(small, "c", ["k"], 5)
    assert {r.fold for r in few.where("c <> 'd'").collect()} == {0, 1, 2} and few.where("c = 'd'").count() == 9
