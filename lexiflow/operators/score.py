"""Prediction and scoring: batch predictor (M1), vocabulary predictor (M3
for both tasks), exact match (A1), accuracy (A2), weighted means (A3, W2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.util import let
from ..session import checkpoint_dir
from . import correct as CO
from .predict import Predictor, StripPromptPredictor, batch_predict  # noqa: F401
from .encode import EOS_ID, PAD_ID, encode_columns, with_eos, word_index

# ------------------------------------------------------------------ M3 as predictor


def vocab_predict(df: DataFrame, id_col: str, input_col: str, task_col: str, vocab: DataFrame,
                  cfg: CO.CorrectConfig = CO.CorrectConfig(), out_col: str = "prediction") -> DataFrame:
    """Predictions for prompted rows of both tasks, computed by Spark joins.

    Task 0 (detect): the text with unknown words marked. Task 1 (correct): the
    marked text with each marked unknown word replaced by its best candidate.
    """
    n_det, n_cor = len(cfg.detect_prompt.split(" ")), len(cfg.correct_prompt.split(" "))
    words = T.split_words(F.col(input_col))
    n = F.when(F.col(task_col) == 0, F.lit(n_det)).otherwise(F.lit(n_cor))
    body = F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0)))
    flagged = CO.word_flags(df, id_col, F.struct(input_col, task_col), body, "_w", vocab, cfg)
    pred = F.when(F.col(task_col) == 0, CO.detect_output(F.col("_w"), F.col("_flags"), cfg)).otherwise(
        CO.correct_output(F.col("_w"), F.col("_flags"), cfg))
    return flagged.select(*df.columns, pred.alias(out_col))


# ------------------------------------------------------------------ A1 / A2 / A3 / W2


def generated_ids(pred_ids: Column, max_length: int) -> Column:
    """What a generator returns: decoder start (pad), tokens, end; at most
    ``max_length`` ids."""
    full = F.concat(F.array(F.lit(PAD_ID).cast("bigint")), pred_ids, F.array(F.lit(EOS_ID).cast("bigint")))
    return F.slice(full, 1, max_length)


def exact_match(generated: Column, labels: Column, pad: int) -> Column:
    """Correct iff every non-pad label position equals the generated token one
    step later (the first generated token is the decoder start); missing
    generated tokens count as 0, extra ones are ignored."""
    def matches(gen, lab):
        ok = F.forall(F.sequence(F.lit(0), F.size(lab) - 1), lambda i: (F.get(lab, i) == pad) | (
            F.coalesce(F.get(gen, i + 1), F.lit(0).cast("bigint")) == F.get(lab, i)))
        return F.when(F.size(lab) == 0, F.lit(True)).otherwise(ok)

    return let(generated, lambda gen: let(labels, lambda lab: matches(gen, lab)))


def score_rows(df: DataFrame, pred_ids: str, out_ids: str, max_length: int, model_max_length: int = 512,
               out_col: str = "correct") -> DataFrame:
    """Add ``out_col`` to rows with encoded predictions and outputs; every other
    column stays. Padded label positions never count, so rows are scored
    unpadded and no batches have to be formed."""
    gen = generated_ids(F.col(pred_ids), max_length)
    labels = with_eos(F.col(out_ids), model_max_length)
    return df.withColumn(out_col, exact_match(gen, labels, PAD_ID))


def score_test_set(labels: DataFrame, id_col: str, vocab: DataFrame, cfg: CO.CorrectConfig = CO.CorrectConfig(),
                   max_length: int = 128, predictor: Callable[[], Predictor] | None = None) -> DataFrame:
    """M4: ``labels`` (``input``, ``output``, ``task`` and any other column) with
    ``prediction`` and ``correct``. Predictions come from the user's model or,
    without one, from the vocabulary corrector. Write it with ``write_csv``."""
    if predictor is None:
        pred = vocab_predict(labels, id_col, "input", "task", vocab, cfg)
    else:
        pred = batch_predict(labels, "input", predictor, "prediction")
    coded = encode_columns(pred, id_col, {"prediction": "_pred_ids", "output": "_out_ids"}, vocab, word_index(vocab))
    return score_rows(coded, "_pred_ids", "_out_ids", max_length).drop("_pred_ids", "_out_ids")


def evaluate_dataset(labels: DataFrame, id_col: str, vocab: DataFrame, cfg: CO.CorrectConfig = CO.CorrectConfig(),
                     max_length: int = 128, predictor: Callable[[], Predictor] | None = None,
                     by: Sequence[str] = ()) -> DataFrame:
    """JOB5: the accuracy over a labelled set (per group with ``by``)."""
    return accuracy(score_test_set(labels, id_col, vocab, cfg, max_length, predictor), "correct", by)


def accuracy(df: DataFrame, correct_col: str = "correct", by: Sequence[str] = ()) -> DataFrame:
    """Share of correct rows (optionally per group); partial + final aggregate."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col(correct_col).cast("long")).alias("n_correct")]
    counts = df.groupBy(*by).agg(*aggs)
    return counts.withColumn("accuracy", F.col("n_correct").cast("double") / F.col("n_rows").cast("double"))


def _products(df: DataFrame, value_col: str, weight_col: str) -> DataFrame:
    """Add ``_v`` (value * weight as an exact decimal, null if the value does
    not fit or the weight is not whole), ``_d`` (the same as a double), ``_n`` and ``_w`` (weight)."""
    v, n = F.col(value_col), F.col(weight_col)
    whole = F.when(v.isNotNull() & (n.try_cast("decimal(12,0)") == n), n.try_cast("decimal(12,0)"))
    return df.select("*", (v.try_cast("decimal(24,12)") * whole).alias("_v"),
                     (v.cast("double") * n.cast("double")).alias("_d"), whole.alias("_n"),
                     F.when(v.isNotNull(), n).cast("double").alias("_w"))


def _fits() -> list[Column]:
    """Whether decimals of 12 places hold a group: every value fits, and the
    largest is not so small that they would cut its digits."""
    return [((F.count("_d") == F.count("_v")) & (F.count("_w") == F.count("_n"))
             & (F.coalesce(F.max(F.abs("_d")), F.lit(0.0)) >= 1e-3)).alias("_exact")]


def weighted_mean(df: DataFrame, value_col: str, weight_col: str, by: Sequence[str] = ()) -> DataFrame:
    """sum(v*n)/sum(n) per group and one final division: exact decimal sums
    where the group's values fit, else sums of doubles. Null values do not count."""
    agg = _products(df, value_col, weight_col).groupBy(*by).agg(
        F.try_sum("_v").alias("_sv"), F.try_sum("_n").alias("_sn"), F.sum("_d").alias("_sd"), F.sum("_w").alias("_sw"), *_fits())
    exact = F.col("_sv").cast("double") / F.nullif(F.col("_sn").cast("double"), F.lit(0.0))
    rough = F.col("_sd") / F.nullif(F.col("_sw"), F.lit(0.0))
    return agg.select(*by, F.when(F.col("_exact") & F.col("_sv").isNotNull(), exact).otherwise(rough).alias("weighted_mean"))


def running_weighted_mean(df: DataFrame, value_col: str, weight_col: str, part_col: str,
                          order_col: str, out_col: str = "running_mean") -> DataFrame:
    """The meter after each update: cumulative sum(v*n)/sum(n) per ``part_col``
    in ``order_col`` order (unique within a part).

    No window spans a whole part, whatever the values of the order column: rows
    are range-partitioned by (part, order) and sorted; the totals of each
    (partition, part) are prefix-summed, and the window inside one adds the
    rest. Sums are exact decimals where the part's values fit, else doubles.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(n, part_col, order_col)
    rows = _products(sorted_, value_col, weight_col).withColumn("_blk", F.spark_partition_id()).checkpoint(eager=True)
    totals = rows.groupBy(part_col, "_blk").agg(
        F.try_sum("_v").alias("_tv"), F.try_sum("_n").alias("_tn"), F.sum("_d").alias("_td"), F.sum("_w").alias("_tw"))
    fits = rows.groupBy(part_col).agg(*_fits())
    prior = Window.partitionBy(part_col).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    names = {"_tv": "_ov", "_tn": "_on", "_td": "_od", "_tw": "_ow"}
    offsets = totals.select(part_col, "_blk", *[
        F.coalesce(F.sum(t).over(prior), F.lit(0)).alias(o) for t, o in names.items()])
    offsets = offsets.join(fits, part_col)
    key = F.col(part_col)
    upto = Window.partitionBy("_blk", part_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.coalesce(F.try_sum(c).over(upto), F.lit(0)).alias(f"_c{c[1:]}") for c in ("_v", "_n", "_d", "_w")])
    side = offsets.withColumnsRenamed({part_col: "_part", "_blk": "_b"})
    j = local.join(side, key.eqNullSafe(F.col("_part")) & (F.col("_blk") == F.col("_b")))
    exact = (F.col("_ov") + F.col("_cv")).cast("double") / F.nullif((F.col("_on") + F.col("_cn")).cast("double"), F.lit(0.0))
    rough = (F.col("_od") + F.col("_cd")) / F.nullif(F.col("_ow") + F.col("_cw"), F.lit(0.0))
    return j.select(*df.columns, F.when(F.col("_exact"), exact).otherwise(rough).alias(out_col))
