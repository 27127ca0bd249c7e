"""Global rank, sources/sinks and the running meter."""

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import rank as R
from lexiflow.operators import score as SC
from lexiflow.sources import io as IO
from lexiflow.session import scratch_path


def test_global_row_number(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars")
    got = R.global_row_number(docs, [F.col("source"), F.col("n_chars").desc(), F.col("doc_id")], "rn", 5)
    rows = got.collect()
    want = sorted(rows, key=lambda r: (r.source, -r.n_chars, r.doc_id))
    assert [r.rn for r in want] == list(range(1, len(rows) + 1))


def test_csv_round_trip_with_nulls_and_newlines(spark):
    data = [(1, 'line one\nline "two"', "NA"), (2, "  padded  ", ""), (3, "a,b", "x")]
    df = spark.createDataFrame(data, "id int, text string, tag string")
    path = scratch_path(spark, "csv-test")
    IO.write_csv(df, path)
    got = sorted(map(tuple, IO.read_csv(spark, path, df.schema).collect()))
    assert got == [(1, 'line one\nline "two"', None), (2, "  padded  ", None), (3, "a,b", "x")]


def test_missing_prompt_config(spark):
    import pytest
    with pytest.raises(ValueError):
        IO.read_prompt_config(spark, scratch_path(spark, "nothing-here"))


def test_running_mean_blocks(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "event_type", "value", (F.col("event_id") % 4 + 1).alias("n"))
    rows = sorted(ev.collect(), key=lambda r: r.event_id)
    want, acc = {}, {}
    for r in rows:
        sv, sn = acc.get(r.event_type, (0.0, 0))
        sv, sn = sv + r.value * r.n, sn + r.n
        acc[r.event_type] = (sv, sn)
        want[r.event_id] = sv / sn
    got = SC.running_weighted_mean(ev, "value", "n", "event_type", "event_id").collect()
    assert len(got) == len(want)
    for r in got:
        assert abs(r.running_mean - want[r.event_id]) < 1e-9


def test_batch_predict_loads_once_per_task(spark):
    df = spark.createDataFrame([(f"detect typo: w{i}",) for i in range(50)], "t string")
    out = SC.batch_predict(df, "t", lambda: SC.StripPromptPredictor(2)).collect()
    assert sorted(r.results for r in out) == sorted(f"w{i}" for i in range(50))
