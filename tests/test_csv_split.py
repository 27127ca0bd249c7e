"""Files with line breaks in fields, cut into many splits; line files in order."""

import csv
import glob
import random

import pytest
from pyspark.sql import types as T

from lexiflow.sources import io as IO
from lexiflow.sources.csv_split import read_csv_split

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("tag", T.StringType())])


@pytest.fixture
def small_splits(spark):
    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    yield to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def rows(n, seed):
    rnd = random.Random(seed)
    piece = ["word", " ", "\n", "\n\n", '"', ",", "é", '""', "\n\"\n", "x" * 40, ""]
    out = []
    for i in range(n):
        text = "".join(rnd.choice(piece) for _ in range(rnd.choice([0, 1, 5, 30, 200])))
        out.append((i, text, rnd.choice(["a", "NA", "", "line\nbreak", "q\"q"])))
    return out


def expected(data):
    null = set(IO.PANDAS_NULL_TOKENS)
    return sorted(((i, None if t in null else t, None if g in null else g) for i, t, g in data), key=lambda r: r[0])


@pytest.mark.parametrize("size", [150, 1000, 10**9])
def test_rows_of_the_one_task_reader(spark, tmp_path, small_splits, size):
    data = [*rows(120, 1), (1000, "field\n" * 900, "longer than several splits"), *rows(30, 2)]
    for part in range(2):
        with open(tmp_path / f"{part}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(["id", "text", "tag"])
            w.writerows(data[part::2])
    one = sorted(map(tuple, IO.read_csv(spark, str(tmp_path), SCHEMA).collect()), key=lambda r: r[0])
    small_splits(size)
    got = sorted(map(tuple, read_csv_split(spark, str(tmp_path), SCHEMA).collect()), key=lambda r: r[0])
    assert sorted(got, key=repr) == sorted(one, key=repr) == sorted(expected(data), key=repr)
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert (tasks > 10) == (size == 150 or size == 1000)


def test_line_ends_and_bad_files(spark, tmp_path, small_splits):
    small_splits(16)
    (tmp_path / "crlf.csv").write_bytes(b'id,text,tag\r\n1,"a ""b"", c",x\r\n\r\n2,plain,y\r\n3,last,z')
    assert sorted(map(tuple, read_csv_split(spark, str(tmp_path / "crlf.csv"), SCHEMA).collect())) == [
        (1, 'a "b", c', "x"), (2, "plain", "y"), (3, "last", "z")]
    (tmp_path / "empty.csv").write_bytes(b"id,text,tag\n")
    assert read_csv_split(spark, str(tmp_path / "empty.csv"), SCHEMA).count() == 0
    (tmp_path / "odd.csv").write_bytes(b'id,text,tag\n1,"a,x\n')
    with pytest.raises(ValueError, match="odd number"):
        read_csv_split(spark, str(tmp_path / "odd.csv"), SCHEMA)
    (tmp_path / "short.csv").write_bytes(b"id,text,tag\n1,a\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_split(spark, str(tmp_path / "short.csv"), SCHEMA).collect()


def test_files_by_name_are_in_order(spark, tmp_path):
    rnd = random.Random(3)
    data = [(i, rnd.choice("ab"), f"line {i}") for i in range(3000)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "id long, part string, line string").repartition(7)

    def read(folder):
        return "".join(open(f).read() for f in sorted(glob.glob(f"{folder}/part-*"))).splitlines()

    IO.write_lines(df, "line", str(tmp_path / "all"), order_by=["id"])
    assert read(tmp_path / "all") == [f"line {i}" for i in range(3000)]
    IO.write_lines(df, "line", str(tmp_path / "by"), "part", ["id"])
    for p in "ab":
        assert read(tmp_path / "by" / f"part={p}") == [x for _, q, x in sorted(data) if q == p]
