import itertools

import pytest

_n = itertools.count()


@pytest.fixture
def stored(spark, tmp_path):
    """Rows as a stored table of several files."""
    def make(rows, schema, parts=3):
        path = str(tmp_path / f"t{next(_n)}")
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)
    return make
