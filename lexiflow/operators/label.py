"""Synthetic misspelling labels for the detect and correct tasks (JOB3).

The whole job is narrow: every decision for a sentence (selected or not, how
many typos, which words, which typo per copy) is an expression over that
sentence's own row, so the plan has no Exchange and scales with the scan. Only a stop
list too long for an expression (``stop_table``) is joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import typo as TY
from ..functions.draw import draw_hash, scaled, threshold, word32
from ..functions.util import let
from ..session import broadcast_if_small, write_table
from ..sources import io as IO
from .encode import ROW_KEY, with_row_key

DETECT, CORRECT = 0, 1
LABEL_COLUMNS = ("sentence", "input", "output", "task", "num_tokens")
MIN_SENTENCE_CHARS = 5
EXAMPLE_ID = "example_id"
#: So many typos of a sentence get columns of their own; more are made in a lambda. A choice of
#: speed, both give the same rows.
UNROLLED_TYPOS = 8


@dataclass(frozen=True)
class LabelConfig:
    typo_probability: float = 0.5
    max_num_typo: int = 3
    head_mark: str = "$"
    tail_mark: str = "@"
    data_multiple: int = 4
    min_num_characters: int = 4
    num_typo_weights: Sequence[int] | None = (5, 4, 1)
    detect_prompt: str = "detect typo:"
    correct_prompt: str = "correct typo:"
    max_length: int = 120
    seed: int = 2330
    stop_words: Sequence[str] = field(default_factory=tuple)
    on_exhausted: str = "error"

    def cumulative_weights(self) -> list[int]:
        w = list(self.num_typo_weights) if self.num_typo_weights is not None else [1] * self.max_num_typo
        if len(w) != self.max_num_typo:
            raise ValueError("num_typo_weights needs one weight per typo count 1..max_num_typo")
        if any(x < 0 for x in w):
            raise ValueError("weights must be non-negative")
        out, s = [], 0
        for x in w:
            s += x
            out.append(s)
        return out

    def prompt_config(self) -> dict[str, str]:
        return {"correct_prompt": self.correct_prompt, "detect_prompt": self.detect_prompt,
                "head_mark": self.head_mark, "tail_mark": self.tail_mark}


def sentence_key(sentence: Column) -> Column:
    """Default row key for draws: equal sentences get equal draws."""
    return F.md5(sentence)


def typo_count(n_valid: Column, cfg: LabelConfig, h: Column) -> Column:
    """k in 1..min(max_num_typo, n_valid) drawn with the weights truncated at n_valid.

    Equals the original's redraw-until-k-fits loop, in one draw. A row where
    every allowed count has weight 0 (the original never ends) raises.
    """
    cw = F.array(*[F.lit(c) for c in cfg.cumulative_weights()])
    kmax = F.greatest(F.least(F.lit(cfg.max_num_typo), n_valid), F.lit(1))
    total = F.get(cw, kmax - 1).cast("long")
    t = scaled(word32(h, 0), total)
    k = F.size(F.filter(F.slice(cw, F.lit(1), kmax - 1), lambda c: c <= t)) + 1
    return F.when(total > 0, k).otherwise(F.raise_error(F.lit("no typo count has weight")).cast("int"))


def sample_positions(valid_idx: Column, k: Column, seed: int, key: Column) -> Column:
    """k distinct positions of ``valid_idx``, uniform without replacement."""
    # eight hex digits compare like the numbers that they stand for
    start = F.concat_ws("|", F.lit(str(seed)), key, F.lit("pos"), F.lit(""))
    ranked = let(start, lambda s: F.sort_array(F.transform(valid_idx, lambda i: F.struct(
        F.substring(F.md5(F.concat(s, i.cast("string"))), 1, 8).alias("d"), i.alias("i")))))
    return F.transform(F.slice(ranked, F.lit(1), k), lambda s: s["i"])


def stop_positions(df: DataFrame, min_chars: int, stop_table: DataFrame) -> DataFrame:
    """Add ``_stop``: positions of ``_words`` that hold a word of ``stop_table`` (column
    ``word``). The list is broadcast within the checked bounds and shuffled beyond
    them; equal rows (same ``_key`` and words) are looked up together."""
    part = with_row_key(df, "_key", F.col("_words")).repartition(ROW_KEY)
    words = part.select(ROW_KEY, F.posexplode("_words").alias("_i", "word")).where(TY.valid_word(F.col("word"), min_chars))
    hits = words.join(broadcast_if_small(stop_table.select("word")), "word", "left_semi")
    found = hits.groupBy(ROW_KEY).agg(F.collect_set("_i").alias("_stop"))
    out = part.join(found, ROW_KEY, "left").drop(ROW_KEY)
    return out.withColumn("_stop", F.coalesce("_stop", F.array().cast("array<int>")))


def plan_typos(df: DataFrame, text_col: str, cfg: LabelConfig, key_col: str | None = None,
               keep: Sequence[str] = (), stop_table: DataFrame | None = None) -> DataFrame:
    """Per sentence (>= 5 chars): ``_words``, ``_key``, ``_chosen`` (null if no
    typo) and the ``keep`` columns. ``stop_table``: more stop words (``word``), any number."""
    TY.check_min_chars(cfg.min_num_characters)
    key = F.col(key_col) if key_col else sentence_key(F.col(text_col))
    base = (df.where(F.length(text_col) >= MIN_SENTENCE_CHARS)
            .select(F.col(text_col).alias("sentence"), key.alias("_key"),
                    T.split_words(F.col(text_col)).alias("_words"), *keep))
    stop = list(cfg.stop_words)
    if stop_table is not None:
        base = stop_positions(base, cfg.min_num_characters, stop_table)
    selected = word32(draw_hash(cfg.seed, F.col("_key"), "sel"), 0) < F.lit(threshold(cfg.typo_probability))

    def choose(words, row_key):
        valid_idx = F.filter(F.sequence(F.lit(0), F.size(words) - 1),
                             lambda i: TY.valid_word(F.get(words, i), cfg.min_num_characters, stop))
        if stop_table is not None:
            valid_idx = F.array_except(valid_idx, F.col("_stop"))

        def draw(valid):
            k = typo_count(F.size(valid), cfg, draw_hash(cfg.seed, row_key, "cnt"))
            return F.when(F.size(valid) > 0, sample_positions(valid, k, cfg.seed, row_key))

        return let(valid_idx, draw)

    # Bound by let: the optimiser puts what a column stands for into the lambdas that use
    # it (a filter on ``_chosen`` pulls all of this below the split), and there the sentence would
    # be split, and its key hashed, once per word.
    chosen = F.when(selected, let(F.col("_words"), lambda ws: let(F.col("_key"), lambda key: choose(ws, key))))
    return base.select("sentence", "_key", "_words", chosen.alias("_chosen"), *keep)


def label_rows(df: DataFrame, text_col: str = "sentence", cfg: LabelConfig = LabelConfig(),
               key_col: str | None = None, with_id: bool = False, keep: Sequence[str] = (),
               stop_table: DataFrame | None = None) -> DataFrame:
    """Unprompted label rows ``sentence, task, input, output`` (G2/G3) and the
    ``keep`` columns of their sentence.

    ``with_id`` adds ``example_id`` = ``key:copy:task`` (copy -1 for a row
    without typos), unique per row even when two copies come out equal. Keys
    default to the sentence's digest, so sentences that repeat share their draws
    and ids; give ``key_col`` (a row key) where they must differ.

    Not selected, or no valid word: one detect row (s, s, s). Otherwise
    ``data_multiple`` copies, each one detect row (s, typo, marked typo) and
    one correct row (s, marked typo, marked s); copies share positions and
    draw their typos anew. Equal copies are kept.
    """
    planned = plan_typos(df, text_col, cfg, key_col, keep, stop_table)
    head, tail = cfg.head_mark + " ", " " + cfg.tail_mark
    # Copies differ in their chosen words alone: what lies between these is joined once per
    # sentence, and no copy goes over all words again.
    at = F.when(F.col("_chosen").isNotNull(), F.sort_array("_chosen"))
    placed = planned.select("sentence", "_key", *keep, at.alias("_at"), "_words")
    placed = placed.select("sentence", "_key", *keep, "_at", F.when(F.col("_at").isNotNull(), F.struct(
        F.transform("_at", lambda i: F.get("_words", i)).alias("own"), TY.gaps(F.col("_words"), F.col("_at")).alias("between"))).alias("_p"))
    clean = TY.fill_gaps(F.col("_p.between"), F.col("_p.own"), head, tail)
    placed = placed.select("sentence", "_key", *keep, "_at", "_p.own", "_p.between", clean.alias("_clean"))
    copies = F.when(F.col("_at").isNotNull(), F.sequence(F.lit(0), F.lit(cfg.data_multiple - 1)))
    fanned = placed.select("*", F.explode_outer(copies).alias("_copy"))
    if cfg.max_num_typo <= UNROLLED_TYPOS:
        names = [f"_t{j}" for j in range(cfg.max_num_typo)]
        fanned = TY.add_typos(fanned, {c: F.get("own", F.lit(j)) for j, c in enumerate(names)}, cfg.seed, F.col("_key"), F.col("_copy"),
                              {c: F.get("_at", F.lit(j)) for j, c in enumerate(names)}, cfg.on_exhausted)
        typos = F.array(*names)
    else:
        typos = F.zip_with("_at", "own", lambda i, w: TY.generate_typo(w, cfg.seed, F.col("_key"), F.col("_copy"), i, cfg.on_exhausted))
    typed = fanned.select("sentence", "_key", *keep, "_copy", "between", "_clean", typos.alias("_typos"))
    marked = typed.select("sentence", "_key", *keep, "_copy", "_clean",
                          TY.fill_gaps(F.col("between"), F.col("_typos")).alias("_typo_s"),
                          TY.fill_gaps(F.col("between"), F.col("_typos"), head, tail).alias("_mtypo"))

    # the tasks are exploded as numbers and their texts chosen after it, which is compiled
    s, detect = F.col("sentence"), F.col("task") == DETECT
    tasks = F.when(F.col("_copy").isNull(), F.array(F.lit(DETECT))).otherwise(F.array(F.lit(DETECT), F.lit(CORRECT)))
    fanned = marked.select("*", F.explode(tasks).alias("task"))
    out = fanned.select(
        "sentence", "_key", "_copy", *keep, "task",
        F.when(F.col("_copy").isNull(), s).when(detect, F.col("_typo_s")).otherwise(F.col("_mtypo")).alias("input"),
        F.when(F.col("_copy").isNull(), s).when(detect, F.col("_mtypo")).otherwise(F.col("_clean")).alias("output"))
    example_id = F.concat_ws(":", F.col("_key"), F.coalesce(F.col("_copy"), F.lit(-1)).cast("string"),
                             F.col("task").cast("string"))
    cols = ["sentence", F.col("task").cast("int").alias("task"), "input", "output", *keep]
    if with_id:
        cols.append(example_id.alias(EXAMPLE_ID))
    return out.select(*cols)


def tag_tasks(rows: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """Prefix each input with its task's prompt (G4/T7)."""
    prompted = F.when(F.col("task") == DETECT, T.add_prompt(cfg.detect_prompt, F.col("input"))) \
        .otherwise(T.add_prompt(cfg.correct_prompt, F.col("input")))
    return rows.withColumn("input", prompted)


def subword_counter(load: Callable[[], Callable[[list[str]], list[int]]]) -> Callable[[Column], Column]:
    """E1 with a user's sub-word model: a counter for ``budget_tokens``.

    ``load()`` runs once per task and returns a function from a batch of texts
    to their token counts (end token included, as the model counts it); texts
    cross into Python as Arrow batches, other columns stay in the JVM.
    """

    @F.pandas_udf("int")
    def _count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = load()
        for s in batches:
            yield pd.Series(count(s.tolist()), index=s.index, dtype="int32")

    return lambda c: _count(c)


def budget_tokens(rows: DataFrame, max_length: int, counter=T.count_tokens) -> DataFrame:
    """Count tokens of ``input`` (E1) and keep rows within ``max_length`` (P6).
    ``counter``: the built-in word counter, or ``subword_counter(...)``."""
    counted = rows.withColumn("num_tokens", counter(F.col("input")))
    return counted.where(F.col("num_tokens") <= max_length)


def label_sentences(df: DataFrame, text_col: str = "sentence", cfg: LabelConfig = LabelConfig(),
                    key_col: str | None = None, with_id: bool = False,
                    counter=T.count_tokens, keep: Sequence[str] = (),
                    stop_table: DataFrame | None = None) -> DataFrame:
    """JOB3 rows ``sentence, input, output, task, num_tokens`` (prompted,
    budgeted) and the ``keep`` columns."""
    rows = tag_tasks(label_rows(df, text_col, cfg, key_col, with_id, keep, stop_table), cfg)
    cols = list(LABEL_COLUMNS) + list(keep) + ([EXAMPLE_ID] if with_id else [])
    return budget_tokens(rows, cfg.max_length, counter).select(*cols)


def union_rows(first: DataFrame, *more: DataFrame) -> DataFrame:
    """U1: rows of all frames by column name, duplicates kept."""
    for df in more:
        first = first.unionByName(df)
    return first


#: A stop-word file of at most so many words becomes part of the plan; a longer one is
#: joined. Both give the same rows.
PLAN_STOP_WORDS = 10_000


def label_files(spark, lines_path: str, csv_path: str, config_path: str, cfg: LabelConfig = LabelConfig(),
                stop_words_path: str | None = None, counter=T.count_tokens) -> DataFrame:
    """JOB3 from file to file: read a line file (and a stop-word file), label its
    sentences, write them as CSV and the prompt config beside; returns what was
    written. Every line has draws of its own, also one that repeats (the key is the
    line's place in its file). The stop-word file may hold any number of words."""
    stop_table = None
    if stop_words_path is not None:
        stop = write_table(IO.read_stop_words(spark, stop_words_path).where("word <> ''").distinct(), "stop-words")
        words = [r.word for r in stop.limit(PLAN_STOP_WORDS + 1).collect()]
        if len(words) > PLAN_STOP_WORDS:
            stop_table = stop
        else:
            cfg = replace(cfg, stop_words=tuple(sorted({*cfg.stop_words, *words})))
    lines = IO.read_numbered_lines(spark, lines_path, "sentence", "line_key")
    rows = label_sentences(lines, "sentence", cfg, "line_key", counter=counter, stop_table=stop_table)
    IO.write_csv(rows, csv_path)
    IO.write_prompt_config(spark, config_path, cfg.prompt_config())
    return IO.read_csv(spark, csv_path, rows.schema)
