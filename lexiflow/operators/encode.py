"""Vocabulary, word -> id lookup and fixed/longest padding (A5, J3, E1-E3).

Tokens are the non-empty blank-separated words. Ids 0, 1, 2 are reserved for
padding, end of sequence and unknown words; the vocabulary's words follow by
frequency (descending), then word.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import BROADCAST_MAX_BYTES, broadcast_if_small, write_table
from .rank import global_row_number

PAD_ID, EOS_ID, UNK_ID = 0, 1, 2
N_RESERVED = 3
LABEL_PAD = -100


def tokens(c: Column) -> Column:
    return F.filter(T.split_words(c), lambda w: w != "")


def vocabulary(df: DataFrame, text_col: str, min_freq: int = 1) -> DataFrame:
    """``word, freq, word_id`` over the tokens of ``text_col``.

    Counting is a partial-then-final aggregate (hot words collapse map-side);
    ids come from a distributed global rank, not a single-task window.
    """
    words = df.select(F.explode(tokens(F.col(text_col))).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_freq)
    counts = write_table(counts, "word-counts")  # the range partitioning reads its input twice
    ranked = global_row_number(counts, [F.col("freq").desc(), F.col("word").asc()], "_rank")
    return ranked.select("word", "freq", (F.col("_rank") - 1 + N_RESERVED).alias("word_id"))


ROW_KEY = "_row_key"


def with_row_key(df: DataFrame, id_col: str, text: Column) -> DataFrame:
    """Add a digest of (id, text): rows that share it are alike, so a regroup
    by it is right for repeated and null ids."""
    key = F.md5(F.to_json(F.struct(F.col(id_col).alias("i"), text.alias("t"))))
    return df.withColumn(ROW_KEY, key)


def _vocab_side(vocab: DataFrame) -> DataFrame:
    """The vocabulary as the lookup side: broadcast after a size check
    (rows and bytes); a larger one is shuffle-joined (AQE splits hot words)."""
    return broadcast_if_small(vocab.select("word", "word_id"))


#: Bytes of a word in a ``WordIndex`` beyond its letters: hash, id and offset.
_INDEX_OVERHEAD = 20


class WordIndex:
    """Words with their ids as arrays in the order of the words' hashes. Equal hashes stand
    side by side and the words are compared, so no answer depends on a hash."""

    def __init__(self, words: pa.Array, ids: np.ndarray):
        h = _hashes(words)
        order = np.argsort(h, kind="stable")
        self.hashes, self.words, self.ids = h[order], words.take(pa.array(order)), ids[order]

    def look_up(self, words: pa.Array) -> np.ndarray:
        """Ids of ``words`` (distinct, binary), ``UNK_ID`` where there is none."""
        out = np.full(len(words), UNK_ID, np.int64)
        h = _hashes(words)
        at, todo = np.searchsorted(self.hashes, h), np.arange(len(words))
        while len(todo):
            todo = todo[at[todo] < len(self.hashes)]
            todo = todo[self.hashes[at[todo]] == h[todo]]
            same = compute.equal(self.words.take(pa.array(at[todo])), words.take(pa.array(todo))).to_numpy(zero_copy_only=False)
            out[todo[same]] = self.ids[at[todo[same]]]
            todo = todo[~same]
            at[todo] += 1
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        """Token ids of each text in order; a null text has none. Arrow cuts and numbers the words, so
        only the distinct ones of a batch become Python objects."""
        split = compute.split_pattern(compute.fill_null(texts, ""), " ")
        flat = split.flatten().dictionary_encode()
        words, at = flat.dictionary.cast(pa.binary()), flat.indices.to_numpy()
        token = (compute.binary_length(words).to_numpy() > 0)[at]
        ends = np.r_[0, np.cumsum(token)][split.offsets.to_numpy() - split.offsets[0].as_py()]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(self.look_up(words)[at[token]]))


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def word_index(vocab: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> Callable[[Column], Column] | None:
    """What turns a text column into its token ids without moving a row: a function for
    columns, or None if the vocabulary is too large to go to the workers (checked) or has a
    word twice; it is joined then. ``vocab``: a stored table."""
    known = vocab.where("word is not null")
    n, size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    if size + _INDEX_OVERHEAD * n > max_bytes:
        return None
    rows = known.select(F.col("word").cast("binary").alias("word"), F.coalesce(F.col("word_id"), F.lit(UNK_ID)).cast("bigint").alias("id")).toArrow()
    words = rows.column("word").combine_chunks()
    if len(words) != len(words.unique()):
        return None
    index = vocab.sparkSession.sparkContext.broadcast(WordIndex(words, rows.column("id").to_numpy()))

    @F.arrow_udf("array<bigint>")
    def ids_of(texts: pa.Array) -> pa.Array:
        return index.value.encode(texts)

    # Without this the optimiser may put the call into a lambda over what is made of the ids, where no
    # Python function can run. It also leaves a text that is made by lambdas to the call, which
    # Spark then fails to plan; a text that is looked at twice stays a column.
    look_up = ids_of.asNondeterministic()
    return lambda text: F.when(text.isNotNull(), look_up(text)).otherwise(F.array().cast("array<bigint>"))


def encode_words(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame,
                 out_col: str = "ids") -> DataFrame:
    """J3: add ``out_col`` = token ids of ``text_col`` in order (unknown -> 2)."""
    return encode_columns(df, id_col, {text_col: out_col}, vocab)


def _places(text_cols: Sequence[str]) -> list[Column]:
    """Per text an array of its tokens with the text's number and their positions."""
    def of_text(n, c):
        return F.transform(tokens(F.coalesce(F.col(c), F.lit(""))), lambda w, i: F.struct(
            F.lit(n).alias("text"), i.alias("pos"), w.alias("word")))

    return [of_text(n, c) for n, c in enumerate(text_cols)]


def _entries() -> Column:
    """What a regroup collects of the looked-up tokens, in the order of texts and positions."""
    return F.sort_array(F.collect_set(F.struct("text", "pos", F.coalesce(F.col("word_id"), F.lit(UNK_ID)).cast("bigint").alias("id"))))


def _ids_of(entries: str, n: int) -> Column:
    return F.transform(F.filter(entries, lambda e: e["text"] == n), lambda e: e["id"])


def encode_columns(df: DataFrame, id_col: str, text_cols: dict[str, str], vocab: DataFrame,
                   index: Callable[[Column], Column] | None = None) -> DataFrame:
    """J3 for several texts at once: add, per ``text column -> ids column``, the token ids.

    With ``index`` (a prebuilt ``word_index(vocab)``) each row's texts are looked up where the row
    is. Without one:

    Explode with positions, left-join the vocabulary, regroup per (id, texts)
    and order by position; ids may repeat or be null. A group is one row's texts (equal
    rows collapse in the regroup), so it is bounded.

    The rows are hash-partitioned by that key once; the broadcast lookup keeps
    the partitioning, so the regroup and the join back need no further exchange.
    """
    if index is not None:
        return df.withColumns({out: index(F.col(c)) for c, out in text_cols.items()})
    part = with_row_key(df, id_col, F.struct(*text_cols)).repartition(ROW_KEY)
    ex = part.select(ROW_KEY, F.inline(F.concat(*_places(list(text_cols)))))
    looked = ex.join(_vocab_side(vocab), "word", "left")
    grouped = looked.groupBy(ROW_KEY).agg(_entries().alias("_e"))
    outs = list(text_cols.values())
    ids = grouped.select(ROW_KEY, *[_ids_of("_e", n).alias(o) for n, o in enumerate(outs)])
    out = part.join(ids, ROW_KEY, "left").drop(ROW_KEY)
    return out.withColumns({o: F.coalesce(F.col(o), F.array().cast("array<bigint>")) for o in outs})


def encode_texts(df: DataFrame, text_cols: dict[str, str], vocab: DataFrame,
                 index: Callable[[Column], Column] | None = None) -> DataFrame:
    """J3 for rows whose texts are not needed after it: ``text_cols`` (text column ->
    ids column) are replaced by their token ids in order (unknown -> 2).

    With ``index`` (a prebuilt ``word_index(vocab)``) each row's texts are looked up where the row
    is, and no row moves. Without one, all texts of a row go in one pass: the rows are hash-partitioned once by a digest of all
    their columns, their tokens are looked up and regrouped by the row's other columns, and
    nothing is joined back. Rows that are alike are one group, which counts them (by the one
    entry without a word that each row has) and is repeated at the end.
    """
    keep = [c for c in df.columns if c not in text_cols]
    if index is not None:
        return df.select(*keep, *[index(F.col(c)).alias(out) for c, out in text_cols.items()])
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = df.select(F.md5(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]))).alias(ROW_KEY),
                     *[F.col(c).alias(k) for c, k in zip(keep, kept)], *text_cols).repartition(ROW_KEY)

    end = F.array(F.struct(F.lit(len(text_cols)).alias("text"), F.lit(0).alias("pos"), F.lit(None).cast("string").alias("word")))
    ex = rows.select(ROW_KEY, *kept, F.inline(F.concat(*_places(list(text_cols)), end)))
    looked = ex.join(_vocab_side(vocab), "word", "left")
    grouped = looked.groupBy(ROW_KEY, *kept).agg(
        _entries().alias("_e"), F.count(F.when(F.col("text") == len(text_cols), 1)).alias("_n"))
    ids = [_ids_of("_e", n).alias(out) for n, out in enumerate(text_cols.values())]
    out = grouped.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], *ids,
                         F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))).alias("_copy"))
    return out.drop("_copy")


def with_eos(ids: Column, max_length: int) -> Column:
    """Truncate to ``max_length`` keeping the end token."""
    return F.concat(F.slice(ids, 1, max_length - 1), F.array(F.lit(EOS_ID).cast("bigint")))


def pad_to(ids: Column, length: Column | int, pad: int) -> Column:
    n = length if isinstance(length, Column) else F.lit(length)
    return F.concat(ids, F.array_repeat(F.lit(pad).cast("bigint"), F.greatest(n - F.size(ids), F.lit(0))))


def attention_mask(n_real: Column, length: Column | int) -> Column:
    n = length if isinstance(length, Column) else F.lit(length)
    ones = F.least(n_real, n)
    return F.concat(F.array_repeat(F.lit(1), ones), F.array_repeat(F.lit(0), n - ones))


def encode_fixed(df: DataFrame, input_ids: str, output_ids: str, max_length: int) -> DataFrame:
    """E2: ids + eos, truncated and padded to ``max_length``; mask 1/0;
    labels = encoded output with padding as -100."""
    full_in, full_out = with_eos(F.col(input_ids), max_length), with_eos(F.col(output_ids), max_length)
    x = df.select("*", full_in.alias("_fin"), full_out.alias("_fout"))
    return x.select(
        *[c for c in df.columns if c not in (input_ids, output_ids)],
        pad_to(F.col("_fin"), max_length, PAD_ID).alias("input_ids"),
        attention_mask(F.size("_fin"), max_length).alias("attention_mask"),
        pad_to(F.col("_fout"), max_length, LABEL_PAD).alias("labels"))


def encode_longest(df: DataFrame, input_ids: str, output_ids: str, order: list,
                   batch_size: int = 100, model_max_length: int = 512) -> DataFrame:
    """E3: batches of ``batch_size`` rows in ``order``; each padded (with 0) to
    its batch's longest, truncated to ``model_max_length``."""
    numbered = global_row_number(df, order, "_rn")
    x = numbered.select(
        "*", F.floor((F.col("_rn") - 1) / batch_size).alias("batch"),
        with_eos(F.col(input_ids), model_max_length).alias("_fin"),
        with_eos(F.col(output_ids), model_max_length).alias("_fout"))
    # only the lengths are grouped: the rows stay where they are, unless there are too many
    # batches to broadcast
    longest = write_table(x.groupBy("batch").agg(F.max(F.size("_fin")).alias("_lin"), F.max(F.size("_fout")).alias("_lout")),
                          "batch-lengths")
    x = x.join(broadcast_if_small(longest), "batch")
    return x.select(
        *[c for c in df.columns if c not in (input_ids, output_ids)], "batch",
        pad_to(F.col("_fin"), F.col("_lin"), PAD_ID).alias("input_ids"),
        attention_mask(F.size("_fin"), F.col("_lin")).alias("attention_mask"),
        pad_to(F.col("_fout"), F.col("_lout"), PAD_ID).alias("labels"))


def encode_dataset(labels: DataFrame, id_col: str, vocab: DataFrame, max_length: int = 128,
                   index: Callable[[Column], Column] | None = None) -> DataFrame:
    """JOB4: ``labels`` (``input``, ``output`` and any other column, such as the
    split) with ``input_ids``, ``attention_mask`` and ``labels`` of fixed
    length in place of the two texts. Train, validation and test rows go in one
    pass; ``vocab`` comes from the training rows. ``index``: a prebuilt ``word_index(vocab)``."""
    coded = encode_texts(labels, {"input": "_in_ids", "output": "_out_ids"}, vocab, index)
    return encode_fixed(coded, "_in_ids", "_out_ids", max_length)
