"""Identity of lines and stop lists of any size (JOB3)."""

import collections

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import label as L
from lexiflow.sources import io as IO

CFG = L.LabelConfig(typo_probability=1.0, data_multiple=2)


@pytest.fixture
def lines(tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    rows = {name: [f"common words appear quite often {i % 3}" if i % 2 else f"line number {i} of {name} é" for i in range(n)]
            for name, n in (("a.txt", 400), ("b.txt", 90), ("empty.txt", 0))}
    for name, texts in rows.items():
        (folder / name).write_bytes("".join(t + ("\r\n" if i % 5 == 0 else "\n") for i, t in enumerate(texts)).encode())
    return str(folder), rows


def numbered(spark, path):
    return {r.line_key: r.sentence for r in IO.read_numbered_lines(spark, path).collect()}


def test_keys_are_the_same_under_any_split_size(spark, lines):
    path, rows = lines
    whole = numbered(spark, path)
    assert len(whole) == 490  # repeated lines differ
    assert collections.Counter(whole.values()) == collections.Counter(t for texts in rows.values() for t in texts)
    # the key is the place in the file
    where = IO.read_numbered_lines(spark, path).withColumn("file", F.lit(f"file:{path}/a.txt"))
    key = lambda i: F.md5(F.concat_ws(":", "file", F.lit(str(i))))
    assert where.where(F.col("line_key") == key(7)).first().sentence == rows["a.txt"][7]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (97, 1500):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 0)
            assert numbered(spark, path) == whole
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_repeated_lines_have_draws_of_their_own(spark, tmp_path):
    src = tmp_path / "l.txt"
    src.write_text("several letters within these sentences\n" * 20)
    got = L.label_files(spark, str(src), str(tmp_path / "o"), str(tmp_path / "c"), CFG)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == 20 * 2 * 2 and len(set(rows)) > 60


def test_no_lines(spark, tmp_path):
    src = tmp_path / "l.txt"
    src.write_text("")
    assert IO.read_numbered_lines(spark, str(src)).count() == 0


def test_a_long_stop_list_equals_the_literal_one(spark, tmp_path, lines, monkeypatch):
    path, _ = lines
    stop = tmp_path / "stop.txt"
    stop.write_text("\n".join(["common", "often", "number", "", "  quite "] + [f"stop{i}" for i in range(200)]))
    run = lambda out: sorted(map(tuple, L.label_files(
        spark, path, str(tmp_path / out), str(tmp_path / f"c{out}"), CFG, str(stop)).collect()))
    literal = run("a")
    monkeypatch.setattr(L, "PLAN_STOP_WORDS", 100)
    assert run("b") == literal
    marked = [r[1] for r in literal if r[3] == L.CORRECT]
    assert marked and not any("$ common @" in m or "$ often @" in m for m in marked)


def test_two_hundred_thousand_stop_words(spark, tmp_path, lines):
    path, _ = lines
    stop = tmp_path / "stop.txt"
    stop.write_text("\n".join(["common", "often"] + [f"stop{i}" for i in range(200_000)]))
    got = L.label_files(spark, path, str(tmp_path / "a"), str(tmp_path / "c"), CFG, str(stop))
    rows = IO.read_numbered_lines(spark, path)
    want = L.label_sentences(rows, "sentence", L.replace(CFG, stop_words=("common", "often")), "line_key")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_equal_rows_and_null_keys_with_a_stop_table(spark):
    df = spark.createDataFrame([("many different words here", None), ("many different words here", None),
                                ("many different words here", "k"), (None, "n"), ("", "e")], "sentence string, key string")
    stop = spark.createDataFrame([("different",), ("words",)], "word string")
    got = L.label_rows(df, cfg=CFG, key_col="key", stop_table=stop)
    want = L.label_rows(df, cfg=L.replace(CFG, stop_words=("different", "words")), key_col="key")
    order = lambda d: sorted(map(str, d.collect()))
    assert order(got) == order(want) and len(order(want)) > 0
