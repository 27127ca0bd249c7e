"""Scans and sinks: header CSV, line files, stop words, prompt config."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.text import strip_space
from ..session import broadcast_if_small, write_table

# The strings pandas.read_csv turns into missing values by default.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_CSV_OPTS = dict(header=True, quote='"', escape='"')


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_tokens=PANDAS_NULL_TOKENS, multi_line: bool = True) -> DataFrame:
    """Header CSV with quoted multi-line fields; pandas' null tokens become null.

    Spark's reader does not split a file with line breaks inside fields, so each
    file is one task; ``csv_split.read_csv_split`` reads large ones in many tasks, and
    ``multi_line=False`` lets Spark split files that have no such breaks.
    All fields are read as text first (Spark's reader knows one null token
    only), tokens are nulled, then fields are cast to ``schema``.
    """
    reader = spark.read.options(multiLine=multi_line, mode="FAILFAST", **_CSV_OPTS)
    if schema is not None:
        reader = reader.schema(
            T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    raw = reader.csv(path)
    return null_and_cast(raw, schema, null_tokens)


def null_and_cast(raw: DataFrame, schema: T.StructType | None, null_tokens) -> DataFrame:
    """Text columns as read -> null tokens nulled, then cast to ``schema``."""
    tokens = list(null_tokens)
    cols = []
    for name in raw.columns:
        c = F.when(F.col(name).isin(tokens), F.lit(None)).otherwise(F.col(name))
        if schema is not None:
            c = c.cast(schema[name].dataType)
        cols.append(c.alias(name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; whitespace is kept as is (Spark trims it by default)."""
    (df.write.mode("overwrite")
     .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **_CSV_OPTS)
     .csv(path))


def write_lines(df: DataFrame, text_col: str, path: str, partition_col: str | None = None,
                order_by: Sequence[str] = ()) -> None:
    """One value per line; one directory per ``partition_col`` value when given.

    With ``order_by`` the files of a directory, read by name, give the rows in that order:
    rows are range-partitioned and sorted by it. The input is written first, as the range
    sampling would run it twice. Without it files are in no particular order.
    """
    cols = [text_col] + ([partition_col] if partition_col else [])
    if order_by:
        keys = [*([partition_col] if partition_col else []), *order_by]
        df = write_table(df.select(*dict.fromkeys([*cols, *keys])), "lines-to-sort")
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = df.select(*cols).write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.text(path)


def read_lines(spark: SparkSession, path: str, out_col: str = "sentence") -> DataFrame:
    """Lines with outer (Unicode) whitespace stripped; blank lines stay as ''."""
    raw = spark.read.text(path)
    rest = [c for c in raw.columns if c != "value"]
    return raw.select(*rest, strip_space(F.col("value")).alias(out_col))


def read_numbered_lines(spark: SparkSession, path: str, out_col: str = "sentence", key_col: str = "line_key") -> DataFrame:
    """``read_lines`` with ``key_col``, the identity of each line: a digest of its file's
    path and its number in the file, the same however the files are split.

    The lines are written once with their split and their order in it; the lines of the
    splits before (one count per split, so a small table) are added to that order.
    """
    raw = spark.read.text(path)
    rest = [c for c in raw.columns if c != "value"]
    src = raw.select(*rest, "value", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_start"),
                     F.monotonically_increasing_id().alias("_at"))
    lines = write_table(src, "lines")
    splits = lines.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_add"))
    numbered = lines.join(broadcast_if_small(write_table(splits, "line-splits")), ["_file", "_start"])
    key = F.md5(F.concat_ws(":", "_file", (F.col("_at") + F.col("_add")).cast("string")))
    return numbered.select(*rest, strip_space(F.col("value")).alias(out_col), key.alias(key_col))


def read_stop_words(spark: SparkSession, path: str | None) -> DataFrame:
    """Stripped stop words. No path means no stop words; a path that cannot be
    read is an error."""
    if path is None:
        return spark.createDataFrame([], "word string")
    raw = spark.read.text(path)
    return raw.select(strip_space(F.col("value")).alias("word"))


PROMPT_KEYS = ("correct_prompt", "detect_prompt", "head_mark", "tail_mark")


def write_prompt_config(spark: SparkSession, path: str, config: dict[str, str]) -> None:
    missing = [k for k in PROMPT_KEYS if k not in config]
    if missing:
        raise ValueError(f"prompt config lacks {missing}")
    row = json.dumps({k: config[k] for k in PROMPT_KEYS}, sort_keys=True, ensure_ascii=False)
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_prompt_config(spark: SparkSession, path: str) -> dict[str, str]:
    """The four prompt strings, from JSON of any layout (one line or indented).
    A path that cannot be read, an empty file and a missing field are errors."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in PROMPT_KEYS])
    try:
        rows = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").take(1)
    except AnalysisException as e:
        raise ValueError(f"no prompt config can be read from {path}") from e
    if not rows:
        raise ValueError(f"the prompt config {path} is empty")
    config = rows[0].asDict()
    missing = [k for k, v in config.items() if v is None]
    if missing:
        raise ValueError(f"the prompt config {path} lacks {missing}")
    return config
