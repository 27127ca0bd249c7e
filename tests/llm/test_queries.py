"""Registered queries against DuckDB, and the pipeline stage by stage."""

import collections

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from check_oracle import digest
from lexiflow.llm.catalog import LLM_ORACLE, LLM_QUERIES
from lexiflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(LLM_ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want)
    assert digest(df.columns, rows) == digest(cols, want)


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(names) <= set(LLM_QUERIES)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in C.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(out)
        after = spark.read.parquet(out)
        seen[name] = after.count()
        if name != "pack":
            assert after.columns == columns
            assert after.exceptAll(docs).isEmpty()  # rows as they came
            docs = after
    texts = [r.text for r in docs.collect()]
    assert len(set(texts)) == len(texts)  # no copies
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in t for b in bench for t in texts)  # no benchmark item
    whole = C.run(spark, SF).collect()
    assert len(whole) == seen["pack"]
    assert {r.doc_id for r in whole} == {r.doc_id for r in docs.collect()}
    assert len(texts) > 0.6 * spark.read.parquet(f"{SF}/documents.parquet").count()  # clean documents stay


def test_pipeline_takes_odd_rows(spark, stored, tmp_path):
    long = " ".join(f"word{i} thing{i * 7}" for i in range(3000))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, long, "en", "s", 9), (2, long, "en", "s", 9), (3, "x", None, "s", 1)]
    odd = stored(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = odd.selectExpr("*", "'a' as `row`", "'b' as rid", "1 as _rid", "2 as sig", "3 as f")
    path = str(tmp_path / "odd")
    odd.write.parquet(path)
    docs = spark.read.parquet(path)
    for i, (name, stage) in enumerate(C.STAGES):
        out = str(tmp_path / f"s{i}")
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        if name in ("language", "quality"):
            assert collections.Counter(r.doc_id for r in docs.collect())[2] == 2
        if name in ("near_duplicates", "decontamination"):
            assert [r.doc_id for r in docs.collect()] == [2]
    assert {r.doc_id for r in docs.collect()} == {2}
    empty = odd.where("false")
    empty.write.parquet(str(tmp_path / "empty"))
    for name, stage in C.STAGES:
        assert stage(spark, spark.read.parquet(str(tmp_path / "empty")), SF).count() == 0
