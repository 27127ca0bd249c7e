"""Every registered query against its DuckDB SQL on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import digest
from lexiflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


# queries of the optional subpackage are tested beside it
CORE = sorted(n for n in E.queries() if n in E.QUERIES)


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sentence", "input", "output", "task", "num_tokens", "split"]
