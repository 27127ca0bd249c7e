"""Stratified k-fold against a direct Python statement of the rule."""

from pyspark.sql import functions as F

from lexiflow.operators import split as SP
from lexiflow.plans import catalog as C


def py_stratified_folds(classes, k):
    """Unshuffled stratified k-fold: classes by first appearance, round-robin
    quotas over the class-sorted layout, blocks in row order inside a class."""
    order = list(dict.fromkeys(classes))
    enc = {c: i for i, c in enumerate(order)}
    counts = [0] * len(order)
    for c in classes:
        counts[enc[c]] += 1
    layout = sorted(enc[c] for c in classes)
    alloc = [[0] * len(order) for _ in range(k)]
    for j, c in enumerate(layout):
        alloc[j % k][c] += 1
    per_class = {}
    for c in range(len(order)):
        per_class[c] = [f for f in range(k) for _ in range(alloc[f][c])]
    seen = [0] * len(order)
    out = []
    for c in classes:
        e = enc[c]
        out.append(per_class[e][seen[e]])
        seen[e] += 1
    return out


def _table(spark, sf_dir):
    return C.sentence_table(spark, sf_dir).select("doc_id", "sentence_pos", "source")


def test_folds_match_rule(spark, sf_dir):
    st = _table(spark, sf_dir)
    for parts in (1, 13):  # one partition, and several that cut a class
        got = SP.stratified_kfold(st, "source", ["doc_id", "sentence_pos"], 10, n_partitions=parts)
        rows = got.orderBy("doc_id", "sentence_pos").collect()
        want = py_stratified_folds([r.source for r in rows], 10)
        assert [r.fold for r in rows] == want


def test_fold_sizes_balanced(spark, sf_dir):
    got = SP.stratified_kfold(_table(spark, sf_dir), "source", ["doc_id", "sentence_pos"], 10)
    sizes = got.groupBy("source", "fold").count().groupBy("source").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r.spread <= 1 for r in sizes)


def test_roles_disjoint_and_complete():
    roles = SP.fold_roles(2330)
    assert sorted(roles) == list(range(10))
    vals = list(roles.values())
    assert vals.count("train") == 7 and vals.count("validation") == 1 and vals.count("test") == 2


def test_too_few_rows_per_class_raises(spark):
    import pytest
    df = spark.createDataFrame([(i, 0, "a") for i in range(3)], "doc_id long, sentence_pos int, source string")
    with pytest.raises(Exception):
        SP.stratified_kfold(df, "source", ["doc_id", "sentence_pos"], 10).collect()
