"""Header CSV with line breaks inside quoted fields, read by many tasks per file.

A line break ends a record only if an even number of quotes stand before it in the
file: a quoted field opens and closes with one, and a quote inside it is doubled. So
the parity of the quotes before each split tells its first line apart from the middle
of a field. Counting quotes is one narrow pass; the parities before the splits are a
prefix sum over one row per split. In the second pass each task puts the lines of its
split together to records. A record that reaches over the end of a split leaves a piece
in each, and only these pieces are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_table
from .io import _CSV_OPTS, PANDAS_NULL_TOKENS, null_and_cast

#: Rows of the split table that are broadcast at most: three numbers each, under 128 MiB.
MAX_SPLITS = 1_000_000
_OUT_BYTES = 4 << 20
_RECORDS = "file long, start long, kind int, first boolean, record string"
_WHOLE, _TAIL, _HEAD = 0, 1, 2  # a record, its beginning at the end of a split, its going on in the next


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, start, odd, quotes, value) in order -> records and pieces of records."""
    schema = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("kind", pa.int32()),
                        ("first", pa.bool_()), ("record", pa.large_string())])
    out, held = [], 0
    at, lines, kind, first = None, None, _WHOLE, False

    def emit(k: int) -> None:
        nonlocal first, held
        text = "\n".join(lines)
        out.append((*at, k, first, text))
        first, held = False, held + len(text)

    def batch() -> pa.RecordBatch:
        nonlocal out, held
        columns, out, held = list(zip(*out)), [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for b in batches:
        columns = b.to_pydict()
        for file, start, odd, quotes, value in zip(*(columns[c] for c in ("file", "start", "odd", "quotes", "value"))):
            if odd is None:
                raise RuntimeError("the splits of the files changed between two scans; read them again")
            if (file, start) != at:
                if lines is not None:
                    emit(kind)  # the end of a split inside a field
                at, first = (file, start), start == 0
                lines, kind = ([], _HEAD) if odd else (None, _WHOLE)
            if lines is None:
                if value in ("", "\r"):
                    continue  # blank lines between records, as in the one-task reader
                lines, kind = [], _TAIL
            lines.append(value)
            inside = (kind == _HEAD and quotes % 2 == 0) or (kind == _TAIL and (quotes % 2 == 1) == (len(lines) == 1))
            if not inside:
                emit(_HEAD if kind == _HEAD else _WHOLE)
                lines = None
            if held > _OUT_BYTES:
                yield batch()
        if out:
            yield batch()
    if lines is not None:
        emit(kind)
    if out:
        yield batch()


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType,
                   null_tokens=PANDAS_NULL_TOKENS) -> DataFrame:
    """``read_csv`` of files that hold line breaks in fields, with several tasks per file.

    Every file has a header line. A quote stands only around a field or doubled inside a
    quoted one; a file with an odd number of quotes is an error, a row with a wrong number
    of fields fails the job. Lines end with \\n or \\r\\n. Neither directory columns nor
    the order of rows are kept. The files must not change while they are read; if the
    splits change between the two passes (another split size), the job fails.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    counts = write_table(raw.groupBy("file", "start", "length").agg(F.sum("quotes").alias("quotes")), "csv-splits")
    if counts.groupBy("file").agg((F.sum("quotes") % 2).alias("odd")).where("odd = 1").limit(1).count():
        raise ValueError(f"a file of {path} has an odd number of quotes")
    if counts.count() > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = counts.select("file", "start", "length", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    # a broadcast join keeps the lines of a split together and in order
    lines = raw.join(F.broadcast(write_table(splits, "csv-parity")), ["file", "start", "length"], "left")
    found = write_table(lines.select("file", "start", "odd", "quotes", "value").mapInArrow(_records, _RECORDS), "csv-records")

    pieces = found.where(F.col("kind") != _WHOLE)
    # a split's piece of the record that began before it comes ahead of the one that begins in it
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == _TAIL)
    chained = pieces.withColumn("chain", F.sum(F.when(F.col("kind") == _TAIL, 1).otherwise(0)).over(order))
    joined = chained.groupBy("file", "chain").agg(
        F.array_sort(F.collect_list(F.struct("start", (F.col("kind") == _TAIL).alias("tail"), "record"))).alias("p"),
        F.max("first").alias("first"))
    # all lines of a chain are in it, so the line break between two pieces is the only thing to add
    whole = found.where(F.col("kind") == _WHOLE).select("first", "record").unionByName(
        joined.select("first", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    body = F.when(F.col("record").endswith("\r"), F.substring(F.col("record"), F.lit(1), F.length("record") - 1)).otherwise(F.col("record"))
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    opts = {"mode": "FAILFAST", "multiLine": "true", "quote": _CSV_OPTS["quote"], "escape": _CSV_OPTS["escape"]}
    rows = whole.where(~F.col("first")).select(F.from_csv(body, F.lit(_ddl(texts)), opts).alias("r")).select("r.*")
    return null_and_cast(rows, schema, null_tokens)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)
