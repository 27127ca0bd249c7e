"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table  # noqa: F401  (re-exported)

#: Characters between words: blank and \t \n \v \f \r.
SPACE = "\\x20\\x09-\\x0D"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let an Arrow batch hold at most ``rows`` rows (a session setting; a
    smaller one stays), so that long texts do not meet ten thousand at once."""
    if int(spark.conf.get(BATCH_CONF)) > rows or int(spark.conf.get(BATCH_CONF)) <= 0:
        spark.conf.set(BATCH_CONF, str(rows))


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def same(a: Column, b: Column) -> Column:
    """Equality in which null equals null."""
    return a.eqNullSafe(b)


def row_ids(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Add a number that tells rows apart, repeated rows included.

    The number follows from the position in the scanned files, so ``df`` must
    be a stored table (a scan with projections and filters), not the result of
    a shuffle; write such a result first.
    """
    return df.select("*", F.monotonically_increasing_id().alias(name))
