"""Consecutive global row numbers without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into
one task. Instead: range-partition and sort by the order, take
``monotonically_increasing_id`` (partition id in the upper bits, record number in
the lower 33) and write the rows with it (a parquet table under the shared
``spark.checkpoint.dir``, compressed, unlike a checkpoint), count rows per partition (one row per
partition), prefix-sum those counts and add them back with a broadcast whose
size is the partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, write_table

_LOW_BITS = 33


def global_row_number(df: DataFrame, order: Sequence[Column | str], out_col: str = "row_number",
                      n_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based position of the row in ``order`` (ties broken
    by the order's columns only, so make ``order`` total for a stable result).

    The range partitioning samples its input in a job of its own, so an input
    that is expensive to compute should be written (or checkpointed) first.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    with_id = write_table(ordered.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    pid = F.shiftright(F.col("_mid"), _LOW_BITS)
    counts = with_id.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = with_id.join(F.broadcast(offsets), pid == F.col("_pid"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return joined.select(*df.columns, (F.col("_off") + local + 1).alias(out_col))


def prefix_sum(df: DataFrame, order: Sequence[Column | str], value_col: str, out_col: str,
               max_col: str | None = None, n_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all rows before this one in
    ``order`` (exclusive running sum; ``order`` must be total), and, when
    ``max_col`` is given, the maximum of ``value_col`` over all rows.

    Same scheme as ``global_row_number``: range-partition and checkpoint,
    per-partition totals prefix-summed over one row per partition and added
    back through a broadcast of that partition table; the running sum inside
    a partition is a window over that partition's rows only.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    with_id = fixed.withColumn("_mid", F.monotonically_increasing_id())
    with_id = with_id.withColumn("_pid", F.shiftright(F.col("_mid"), _LOW_BITS))
    totals = with_id.groupBy("_pid").agg(F.sum(value_col).alias("_t"), F.max(value_col).alias("_m"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    part_cols = [F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off")]
    if max_col:
        part_cols.append(F.max("_m").over(Window.partitionBy()).alias(max_col))
    offsets = totals.select("_pid", *part_cols)
    inside = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    local = with_id.select("*", F.coalesce(F.sum(value_col).over(inside), F.lit(0)).alias("_loc"))
    joined = local.join(F.broadcast(offsets), "_pid")
    extra = [max_col] if max_col else []
    return joined.select(*df.columns, (F.col("_off") + F.col("_loc")).alias(out_col), *extra)
