"""Labelling: properties of the generated rows, partition independence, plan shape."""

from pyspark.sql import functions as F

from lexiflow.functions import typo as TY
from lexiflow.operators import label as L
from lexiflow.plans import catalog as C
from lexiflow.session import scratch_path

from .test_edit_fuzzy import py_distance


def _unmark(s, head="$", tail="@"):
    return " ".join(w for w in s.split(" ") if w not in (head, tail))


def _sentences(spark, sf_dir):
    path = scratch_path(spark, "test-sentences")
    C.split_sentences_all(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_label_properties(spark, sf_dir):
    sents = _sentences(spark, sf_dir)
    rows = L.label_rows(sents, "sentence", L.LabelConfig()).collect()
    by_sentence = {}
    for r in rows:
        by_sentence.setdefault(r.sentence, []).append(r)
        if r.task == L.DETECT:
            assert _unmark(r.output) == r.input
        else:
            assert _unmark(r.output) == r.sentence
            assert _unmark(r.input) != r.sentence
    for s, rs in by_sentence.items():
        assert len(s) >= 5
        if len(rs) == 1:
            assert (rs[0].input, rs[0].output) == (s, s)
            continue
        assert len(rs) == 2 * 4
        for r in rs:
            if r.task == L.DETECT:
                clean, typo = s.split(" "), r.input.split(" ")
                changed = [i for i, (a, b) in enumerate(zip(clean, typo)) if a != b]
                assert 1 <= len(changed) <= 3
                for i in changed:
                    assert py_distance(clean[i], typo[i]) <= 2


def test_label_independent_of_partitioning(spark, sf_dir):
    sents = _sentences(spark, sf_dir)
    a = L.label_sentences(sents.repartition(1), "sentence").collect()
    b = L.label_sentences(sents.repartition(7), "sentence").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_label_plan_is_narrow(spark, sf_dir):
    sents = _sentences(spark, sf_dir)
    plan = L.label_sentences(sents, "sentence")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_typo_differs_and_is_close(spark):
    words = ["lung", "nodule", "aaaa", "effusion", "ab"]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i int")
    t = TY.generate_typo(F.col("w"), 2330, F.md5("w"), F.lit(0), F.col("i"), on_exhausted="keep")
    got = [r[0] for r in df.select(t).collect()]
    for w, g in zip(words, got):
        assert g != w and py_distance(w, g) <= 2


def test_min_chars_guard():
    import pytest
    with pytest.raises(ValueError):
        TY.check_min_chars(1)


def test_subword_counter_plugs_into_budget(spark, sf_dir):
    """A user counter (here: words + end token, in Python) gives the same
    budgeted rows as the built-in expression."""
    def load():
        return lambda texts: [len([w for w in t.split(" ") if w]) + 1 for t in texts]

    sents = C.split_sentences_all(spark, sf_dir)
    cfg = L.LabelConfig(max_length=20)
    built_in = L.label_sentences(sents, "sentence", cfg)
    plugged = L.label_sentences(sents, "sentence", cfg, counter=L.subword_counter(load))
    assert built_in.count() == plugged.count() > 0
    assert built_in.exceptAll(plugged).count() == 0
