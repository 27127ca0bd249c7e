"""Report table -> de-duplicated sentence table.

Shape of the plan: one narrow stage (null filter, clean, section, segment,
explode, content key) and one shuffle on the content key for keep-first
de-duplication, with partial aggregation before the shuffle so a sentence that
repeats in a third of all reports collapses map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

SENTENCE = "sentence"
SENTENCE_POS = "sentence_pos"
CONTENT = "content"


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop a row when any column is null (or NaN in a floating column)."""
    return df.na.drop(how="any")


def explode_sentences(df: DataFrame, text_col: str, out_col: str = SENTENCE,
                      pos_col: str = SENTENCE_POS, drop_text: bool = True) -> DataFrame:
    """One row per sentence of ``text_col``; other columns are copied.

    A text without sentences yields no row. ``pos_col`` is the sentence's
    position inside its text, needed for any order-dependent step later.
    """
    keep = [c for c in df.columns if not (drop_text and c == text_col)]
    return df.select(*keep, F.posexplode(T.segment_sentence(F.col(text_col))).alias(pos_col, out_col))


def dedup_keep_first(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """Keep, per ``key``, the row that comes first by ``order_cols``.

    ``min(struct(order..., payload...))`` is an ordinary aggregate, so Spark
    pre-aggregates per map task before the shuffle: a hot key sends one row
    per task, not all of its copies. ``dropDuplicates`` would pick an
    arbitrary survivor instead.
    """
    payload = [c for c in df.columns if c != key and c not in order_cols]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)] + [F.col(c) for c in payload]
    first = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_first"))
    out = first.select(
        F.col(key),
        *[F.col(f"_first._o{i}").alias(c) for i, c in enumerate(order_cols)],
        *[F.col(f"_first.{c}").alias(c) for c in payload],
    )
    return out.select(*df.columns)


def prepare_sentences(df: DataFrame, report_col: str, order_cols: Sequence[str],
                      section_header: str = T.DEFAULT_SECTION_HEADER,
                      case_insensitive: bool = True, drop_nulls: bool = True,
                      keep_order: bool = True) -> DataFrame:
    """JOB1: reports -> cleaned, sectioned, segmented, de-duplicated sentences.

    Output: every input column except ``report_col``, then ``sentence_pos``
    (when ``keep_order``; it is the order key inside a report) and ``sentence``.
    """
    if drop_nulls:
        df = drop_null_rows(df)
    cleaned = df.withColumn(report_col, T.typeset_clean(F.col(report_col)))
    sectioned = cleaned.withColumn(
        report_col, T.extract_section(F.col(report_col), section_header, case_insensitive))
    rows = explode_sentences(sectioned, report_col)
    rows = rows.withColumn(CONTENT, T.content_key(F.col(SENTENCE)))
    kept = dedup_keep_first(rows, CONTENT, [*order_cols, SENTENCE_POS])
    out_cols = [c for c in kept.columns if c not in (CONTENT, SENTENCE, SENTENCE_POS)]
    if keep_order:
        out_cols.append(SENTENCE_POS)
    return kept.select(*out_cols, SENTENCE)
