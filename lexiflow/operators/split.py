"""Stratified k-fold, fold roles and split filtering (JOB2).

Fold numbers follow the unshuffled stratified k-fold rule: classes are
numbered by first appearance, rows laid out class after class get fold quota
``j mod K``, and inside a class the first ``quota_0`` rows (in order) get fold
0, the next ``quota_1`` fold 1, and so on.

Scale: a class may hold a third of all rows, so no window runs over a whole
class. Rows are range-partitioned by class and order (sampled bounds, whatever
the keys look like); per (class, partition) we count rows (partial aggregation,
tiny output) and prefix-sum those counts per class. A row's rank in its class is
its partition's offset plus its rank inside the (class, partition) group, which the
sorted, numbered and written partitions give by subtraction. Only classes and order columns
go through that; the first row of each fold, some rows per class, is broadcast to the table.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draw import py_word32
from ..session import broadcast_if_small, checkpoint_dir, write_table
from .rank import prefix_sum

FOLD = "fold"
SPLIT = "split"
TRAIN, VALIDATION, TEST = "train", "validation", "test"
N_FOLDS, N_TRAIN_FOLDS, N_VAL_FOLDS = 10, 7, 1


def _quota(a, b, i: int, k: int):
    """Rows j in [a, b) with j mod k == i: ceil((b-i)/k) - ceil((a-i)/k)."""
    return (F.ceil((b - i) / F.lit(float(k))) - F.ceil((a - i) / F.lit(float(k)))).cast("long")


def class_table(counts: DataFrame, class_col: str, n_splits: int) -> DataFrame:
    """Per class: cumulative fold quotas; one row per class.

    The class offsets (rows of all classes that appear earlier) are a
    distributed prefix sum, so even a very large number of classes never
    meets in one task.
    """
    classes = counts.groupBy(class_col).agg(
        F.sum("_n").alias("_cn"), F.min("_first").alias("_cfirst"))
    classes = prefix_sum(classes, [F.col("_cfirst")], "_cn", "_a", max_col="_maxn")
    a, b = F.col("_a"), F.col("_a") + F.col("_cn")
    quotas = [_quota(a, b, i, n_splits) for i in range(n_splits)]
    cum = [quotas[0]]
    for q in quotas[1:]:
        cum.append(cum[-1] + q)
    return classes.select(class_col, F.array(*cum).alias("_cum"), "_maxn", "_cn")


def stratified_kfold(df: DataFrame, class_col: str, order_cols: Sequence[str],
                     n_splits: int = 5, fold_col: str = FOLD, n_partitions: int | None = None) -> DataFrame:
    """Add ``fold_col`` (int) by unshuffled stratified k-fold.

    Rows without a class form a class of their own.
    ``df`` must be a stored table: it is read for the ranks and again for the result.
    ``order_cols`` define row order (of any type; make it total for a stable
    result). Warns when some class has fewer than ``n_splits`` rows; raises at
    run time when every class has.
    """
    order = list(order_cols)
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranks need the classes and the order alone: other columns are not shuffled
    ranked = _ranked(df.select(class_col, *[c for c in order if c != class_col]), class_col, order, n_splits, n)
    key = F.struct(*[F.col(c) for c in order])
    first, before = F.array_contains("_cum", F.col("_r")), F.array_contains("_cum", F.col("_r") + 1)
    ends = ranked.where(first | before).select(
        F.col(class_col).alias("_class"), key.alias("_key"), "_r", first.alias("_starts"), before.alias("_ends"),
        F.size(F.filter("_cum", lambda c: c == F.col("_r"))).alias("_times"))
    ends = write_table(ends, "fold-ends")  # two rows per class and fold at most
    sides = ends.where("_starts").select("_class", "_key", F.col("_r").alias("_at")).unionByName(
        ends.where("_ends").select("_class", "_key", (F.col("_r") + 1).alias("_at")))
    tied = sides.groupBy("_class", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_a"), F.max("_key").alias("_b"))
    if not tied.where((F.col("_n") > 1) & (F.col("_a") == F.col("_b"))).isEmpty():
        # rows alike in class and order lie on both sides of a fold's end: only numbered rows tell them apart
        rows = _ranked(df, class_col, order, n_splits, n)
        return rows.select(*df.columns, F.size(F.filter("_cum", lambda c: c <= F.col("_r"))).cast("int").alias(fold_col))
    starts = ends.where("_starts").select("_class", "_key", F.explode(F.array_repeat(F.lit(0), F.col("_times"))))
    starts = write_table(starts.groupBy("_class").agg(F.collect_list("_key").alias("_starts")), "fold-starts")
    joined = df.join(broadcast_if_small(starts), F.col(class_col).eqNullSafe(F.col("_class")), "left")
    fold = F.size(F.filter(F.coalesce("_starts", F.array().cast(starts.schema["_starts"].dataType)), lambda x: x <= key)).cast("int")
    return joined.select(*df.columns, fold.alias(fold_col))


def _ranked(df: DataFrame, class_col: str, order: list[str], n_splits: int, n: int) -> DataFrame:
    """``df`` with ``_r``, a row's rank in its class, and ``_cum``, the ends of its class's folds."""
    checkpoint_dir(df.sparkSession)
    ordered = df.repartitionByRange(n, class_col, *order).sortWithinPartitions(class_col, *order)
    # written in order with a running number, so the rank inside a (class, partition) is a
    # subtraction: no window shuffles the rows a second time
    rows = write_table(ordered.withColumn("_blk", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()),
                       "ordered")
    first = F.struct(*[F.col(c) for c in order])
    counts = write_table(rows.groupBy(class_col, "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first"),
                                                             F.min("_mid").alias("_start")), "class-counts")
    classes = write_table(class_table(counts, class_col, n_splits), "classes")
    small, largest = classes.agg(F.count(F.when(F.col("_cn") < n_splits, 1)), F.max("_maxn")).first()
    if small and largest >= n_splits:
        warnings.warn(f"{small} classes have fewer rows than the {n_splits} folds", stacklevel=3)
    prior = Window.partitionBy(class_col).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(class_col, "_blk", "_start",
                            F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_off"))
    # null is a class like any other, so classes are compared null-safe
    classes = classes.select(F.col(class_col).alias("_class"), "_cum", "_maxn")
    offsets = offsets.join(classes, F.col(class_col).eqNullSafe(F.col("_class"))).select(
        "_class", F.col("_blk").alias("_block"), "_start", "_off", "_cum", "_maxn")
    # one row per (class, partition): broadcast within the checked bounds
    joined = rows.join(broadcast_if_small(offsets),
                       F.col(class_col).eqNullSafe(F.col("_class")) & (F.col("_blk") == F.col("_block")))
    cum = F.when(F.col("_maxn") < n_splits, F.raise_error(F.lit(
        f"every class has fewer than {n_splits} rows, one for each fold"))
    ).otherwise(F.col("_cum"))
    return joined.select(*df.columns, (F.col("_off") + F.col("_mid") - F.col("_start")).alias("_r"), cum.alias("_cum"))


def class_counts(df: DataFrame, class_col: str) -> DataFrame:
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n_rows"))


def fold_roles(seed: int, n_folds: int = N_FOLDS, n_train: int = N_TRAIN_FOLDS,
               n_val: int = N_VAL_FOLDS) -> dict[int, str]:
    """Fold -> role: folds ordered by a seeded draw; first ``n_train`` train,
    next ``n_val`` validation, the remaining ones test. Disjoint and complete.

    A pure function of the seed over ``n_folds`` ids (no data involved).
    """
    if n_train + n_val > n_folds:
        raise ValueError("more train and validation folds than folds")
    order = sorted(range(n_folds), key=lambda i: (py_word32(seed, "folds", "fold", i), i))
    roles = {}
    for rank, fold in enumerate(order):
        roles[fold] = TRAIN if rank < n_train else VALIDATION if rank < n_train + n_val else TEST
    return roles


def roles_frame(spark, roles: dict[int, str]) -> DataFrame:
    return spark.createDataFrame(sorted(roles.items()), f"{FOLD} int, {SPLIT} string")


def assign_split(df: DataFrame, roles: dict[int, str], fold_col: str = FOLD) -> DataFrame:
    """Add the role of each row's fold (a literal map; the role table is fixed size)."""
    m = F.create_map(*[x for f, r in sorted(roles.items()) for x in (F.lit(f), F.lit(r))])
    return df.withColumn(SPLIT, F.element_at(m, F.col(fold_col)))


def split_filter(df: DataFrame, roles: dict[int, str], role: str, text_col: str,
                 fold_col: str = FOLD) -> DataFrame:
    """Text of the rows whose fold has ``role``."""
    folds = sorted(f for f, r in roles.items() if r == role)
    return df.where(F.col(fold_col).isin(folds)).select(text_col)


def remaining_folds(spark, df: DataFrame, roles: dict[int, str], fold_col: str = FOLD) -> DataFrame:
    """Folds present in ``df`` that are neither train nor validation, with row counts."""
    taken = roles_frame(spark, roles).where(F.col(SPLIT).isin(TRAIN, VALIDATION)).select(fold_col)
    present = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n_rows"))
    return present.join(F.broadcast(taken), fold_col, "left_anti")


def split_dataset(df: DataFrame, class_col: str, order_cols: Sequence[str], seed: int = 2330,
                  n_folds: int = N_FOLDS, n_train: int = N_TRAIN_FOLDS, n_val: int = N_VAL_FOLDS,
                  n_partitions: int | None = None) -> DataFrame:
    """JOB2: fold per row, then its split role. Write with ``partitionBy('split')``."""
    folded = stratified_kfold(df, class_col, order_cols, n_folds, n_partitions=n_partitions)
    return assign_split(folded, fold_roles(seed, n_folds, n_train, n_val))
