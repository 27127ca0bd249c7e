"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each query reads the fixture tables (or what Spark derives from them) in full.
The matching DuckDB SQL lives in ``oracle.py`` under the same name; output
column names and integer widths agree between the two.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import prepare as P
from ..session import spread
from ..sources.tables import read_table, table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Section header that does occur in the fixture text (the default one does not).
CUSTOM_HEADER = "ation" + T.WORD_CLASS + "* ,"


# Step outputs of the running query call: a step used by several branches of
# one query (JOB1 sentences, the split, the labelled set, the vocabulary) is
# built and written once per call, not once per branch. Nothing is kept
# between calls.
_STEPS: ContextVar[dict | None] = ContextVar("lexiflow_steps", default=None)


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            if _STEPS.get() is not None:  # called from inside another query
                return fn(spark, sf_dir)
            token = _STEPS.set({})
            try:
                return fn(spark, sf_dir)
            finally:
                _STEPS.reset(token)
        QUERIES[name] = run
        return run
    return deco


def step(fn):
    """Memoise ``fn(spark, sf_dir, *args)`` for the duration of one query call."""
    @functools.wraps(fn)
    def run(spark, sf_dir, *args):
        steps = _STEPS.get()
        if steps is None:
            return fn(spark, sf_dir, *args)
        key = (fn.__name__, sf_dir, *args)
        if key not in steps:
            steps[key] = fn(spark, sf_dir, *args)
        return steps[key]
    return run


def documents(spark, sf_dir) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents"))


def cleaned_documents(spark, sf_dir) -> DataFrame:
    d = documents(spark, sf_dir)
    return d.select("doc_id", "lang", "source", "n_chars",
                    T.typeset_clean(F.col("text")).alias("text"))


def document_sentences(spark, sf_dir) -> DataFrame:
    """Every sentence of every cleaned document (no section cut, no dedup)."""
    return P.explode_sentences(cleaned_documents(spark, sf_dir), "text")


@step
def sentence_table(spark, sf_dir) -> DataFrame:
    """JOB1 output on ``documents``: the input of every later step."""
    return P.prepare_sentences(documents(spark, sf_dir), "text", ["doc_id"])


# ---------------------------------------------------------------- JOB1 parts

@query("newline_to_space")
def q_newline_to_space(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", T.newline_to_space(F.col("text")).alias("text_out"))


@query("typeset_clean")
def q_typeset_clean(spark, sf_dir):
    return cleaned_documents(spark, sf_dir).select("doc_id", F.col("text").alias("cleaned"))


@query("extract_section")
def q_extract_section(spark, sf_dir):
    c = cleaned_documents(spark, sf_dir)
    return c.select("doc_id", T.extract_section(F.col("text")).alias("section"))


@query("extract_section_custom")
def q_extract_section_custom(spark, sf_dir):
    c = cleaned_documents(spark, sf_dir)
    return c.select("doc_id", T.extract_section(F.col("text"), CUSTOM_HEADER).alias("section"))


@query("segment_sentence")
def q_segment_sentence(spark, sf_dir):
    c = cleaned_documents(spark, sf_dir)
    seg = c.select("doc_id", T.segment_sentence(F.col("text")).alias("s"))
    return seg.select("doc_id", F.size("s").alias("n_sentences"),
                      F.array_join("s", "\n").alias("sentences"))


@query("explode_sentences")
def q_explode_sentences(spark, sf_dir):
    return document_sentences(spark, sf_dir)


@query("content_key")
def q_content_key(spark, sf_dir):
    s = document_sentences(spark, sf_dir)
    return s.select("doc_id", "sentence_pos", T.content_key(F.col("sentence")).alias("content"))


@query("drop_null_rows")
def q_drop_null_rows(spark, sf_dir):
    d = documents(spark, sf_dir).drop("text")
    lab = read_table(spark, sf_dir, "labels")
    return P.drop_null_rows(d.join(lab, "doc_id", "left"))


@query("prune_columns")
def q_prune_columns(spark, sf_dir):
    s = document_sentences(spark, sf_dir).withColumn("content", T.content_key(F.col("sentence")))
    return s.select(*[c for c in s.columns if c not in ("content", "n_chars")])


@query("dedup_keep_first")
def q_dedup_keep_first(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    keyed = conv.withColumn("content", T.content_key(F.col("text")))
    return P.dedup_keep_first(keyed, "content", ["conv_id", "turn"]).drop("content")


@query("prepare_sentences")
def q_prepare_sentences(spark, sf_dir):
    return sentence_table(spark, sf_dir)


# ---------------------------------------------------------------- JOB2 parts

from ..operators import split as SP  # noqa: E402
from ..sources import io as IO
from ..sources.csv_split import read_csv_split  # noqa: E402
from ..session import scratch_path, write_table  # noqa: E402

SEED = 2330
ORDER = ["doc_id", "sentence_pos"]
CLASS = "source"


@step
def stored_sentences(spark, sf_dir) -> DataFrame:
    """JOB1 output written once (step boundary): JOB2 reads it three times."""
    return write_table(sentence_table(spark, sf_dir), "sentences")


@step
def split_table(spark, sf_dir) -> DataFrame:
    """JOB2 output: sentence table + fold + split. Not written: it is a narrow read of the
    stored sentences, the ranks of the k-fold being stored."""
    return SP.split_dataset(stored_sentences(spark, sf_dir), CLASS, ORDER, seed=SEED)


def roles():
    return SP.fold_roles(SEED)


@query("class_counts")
def q_class_counts(spark, sf_dir):
    return SP.class_counts(sentence_table(spark, sf_dir), CLASS)


@query("stratified_kfold")
def q_stratified_kfold(spark, sf_dir):
    f = SP.stratified_kfold(stored_sentences(spark, sf_dir), CLASS, ORDER, SP.N_FOLDS)
    return f.select("doc_id", "sentence_pos", CLASS, SP.FOLD)


@query("fold_roles")
def q_fold_roles(spark, sf_dir):
    counts = split_table(spark, sf_dir).groupBy(SP.FOLD, SP.SPLIT).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return counts


@query("split_dataset")
def q_split_dataset(spark, sf_dir):
    return split_table(spark, sf_dir).select("doc_id", "sentence_pos", CLASS, SP.FOLD, SP.SPLIT,
                                             "sentence")


@query("split_filter")
def q_split_filter(spark, sf_dir):
    return SP.split_filter(split_table(spark, sf_dir), roles(), SP.TEST, "sentence")


@query("remaining_folds")
def q_remaining_folds(spark, sf_dir):
    return SP.remaining_folds(spark, split_table(spark, sf_dir), roles())


# ------------------------------------------------------- sources and sinks

@query("line_sink")
def q_line_sink(spark, sf_dir):
    path = scratch_path(spark, "lines")
    IO.write_lines(split_table(spark, sf_dir), "sentence", path, SP.SPLIT)
    return spark.read.text(path).select(SP.SPLIT, F.col("value").alias("line"))


@query("line_scan")
def q_line_scan(spark, sf_dir):
    path = scratch_path(spark, "lines")
    IO.write_lines(split_table(spark, sf_dir), "sentence", path, SP.SPLIT)
    return IO.read_lines(spark, path).select(SP.SPLIT, "sentence")


@query("csv_sink")
def q_csv_sink(spark, sf_dir):
    st = sentence_table(spark, sf_dir)
    path = scratch_path(spark, "sentences-csv")
    IO.write_csv(st, path)
    return IO.read_csv(spark, path, st.schema)


@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    d = documents(spark, sf_dir)
    path = scratch_path(spark, "documents-csv")
    IO.write_csv(d, path)
    return IO.read_csv(spark, path, d.schema)


@query("csv_scan_split")
def q_csv_scan_split(spark, sf_dir):
    d = documents(spark, sf_dir)
    path = scratch_path(spark, "documents-csv")
    IO.write_csv(d, path)
    return read_csv_split(spark, path, d.schema)


# ---------------------------------------------------------------- JOB3 parts

from ..functions import draw as D  # noqa: E402
from ..functions import typo as TY  # noqa: E402
from ..operators import label as L  # noqa: E402

LABEL = L.LabelConfig()
BUDGET = 40  # a tighter token budget than the default, so P6 drops rows


def split_sentences_all(spark, sf_dir) -> DataFrame:
    """Every sentence with its split."""
    return split_table(spark, sf_dir).select("sentence", SP.SPLIT)


def all_sentences(spark, sf_dir) -> DataFrame:
    return sentence_table(spark, sf_dir).select("sentence")


def valid_words(spark, sf_dir, source=None) -> DataFrame:
    """One row per valid word (min 4 letters) of every sentence, with its draw key."""
    st = source if source is not None else sentence_table(spark, sf_dir)
    w = st.select("doc_id", "sentence_pos", F.md5("sentence").alias("key"),
                  F.posexplode(T.split_words(F.col("sentence"))).alias("word_pos", "word"))
    return w.where(TY.valid_word(F.col("word"), LABEL.min_num_characters))


def probe_draw(col_key="key", col_pos="word_pos"):
    return D.draw_hash(LABEL.seed, F.col(col_key), "probe", F.col(col_pos))


def _char_op(spark, sf_dir, op):
    w = valid_words(spark, sf_dir)
    h = probe_draw()
    n = F.length("word").cast("long")
    pos = D.scaled(D.word32(h, 1), n)
    pos_s = D.scaled(D.word32(h, 1), n - 1)
    ch = F.lit(TY.ALPHABET).substr((D.scaled(D.word32(h, 2), 26) + 1).cast("int"), F.lit(1))
    word = F.col("word")
    res = {"insert": lambda: TY.insert_char(word, pos, ch), "remove": lambda: TY.remove_char(word, pos),
           "replace": lambda: TY.replace_char(word, pos, ch), "swap": lambda: TY.swap_adjacent(word, pos_s)}[op]()
    return w.select("doc_id", "sentence_pos", "word_pos", "word", res.alias("result"))


@query("insert_char")
def q_insert_char(spark, sf_dir):
    return _char_op(spark, sf_dir, "insert")


@query("remove_char")
def q_remove_char(spark, sf_dir):
    return _char_op(spark, sf_dir, "remove")


@query("replace_char")
def q_replace_char(spark, sf_dir):
    return _char_op(spark, sf_dir, "replace")


@query("swap_adjacent")
def q_swap_adjacent(spark, sf_dir):
    return _char_op(spark, sf_dir, "swap")


@query("generate_typo")
def q_generate_typo(spark, sf_dir):
    w = valid_words(spark, sf_dir)
    t = TY.generate_typo(F.col("word"), LABEL.seed, F.col("key"), F.lit(0), F.col("word_pos"))
    return w.select("doc_id", "sentence_pos", "word_pos", "word", t.alias("typo"))


@query("valid_word")
def q_valid_word(spark, sf_dir):
    st = sentence_table(spark, sf_dir)
    words = T.split_words(F.col("sentence"))
    n_valid = F.size(F.filter(words, lambda w: TY.valid_word(w, LABEL.min_num_characters)))
    return st.select("doc_id", "sentence_pos", F.size(words).alias("n_words"), n_valid.alias("n_valid"))


@query("split_words")
def q_split_words(spark, sf_dir):
    st = sentence_table(spark, sf_dir)
    return st.select("doc_id", "sentence_pos", F.size(T.split_words(F.col("sentence"))).alias("n_words"))


@query("join_words")
def q_join_words(spark, sf_dir):
    st = sentence_table(spark, sf_dir)
    return st.select("doc_id", "sentence_pos",
                     T.join_words(T.split_words(F.col("sentence"))).alias("rejoined"))


@query("add_prompt")
def q_add_prompt(spark, sf_dir):
    st = sentence_table(spark, sf_dir)
    return st.select("doc_id", "sentence_pos", T.add_prompt(LABEL.detect_prompt, F.col("sentence")).alias("input"))


@query("min_sentence_length")
def q_min_sentence_length(spark, sf_dir):
    st = sentence_table(spark, sf_dir)
    return st.where(F.length("sentence") >= L.MIN_SENTENCE_CHARS).select("doc_id", "sentence_pos", "sentence")


@query("portable_draw")
def q_portable_draw(spark, sf_dir):
    st = all_sentences(spark, sf_dir)
    h = D.draw_hash(LABEL.seed, F.md5("sentence"), "sel")
    return st.select("sentence", *[D.word32(h, k).alias(f"u{k}") for k in range(4)])


def _plan(spark, sf_dir):
    return L.plan_typos(all_sentences(spark, sf_dir), "sentence", LABEL)


@query("bernoulli_rows")
def q_bernoulli_rows(spark, sf_dir):
    st = all_sentences(spark, sf_dir)
    h = D.draw_hash(LABEL.seed, F.md5("sentence"), "sel")
    return st.where(D.word32(h, 0) < D.threshold(LABEL.typo_probability))


@query("weighted_count")
def q_weighted_count(spark, sf_dir):
    p = _plan(spark, sf_dir).where(F.col("_chosen").isNotNull())
    return p.select("sentence", F.size("_chosen").alias("num_typo"))


@query("sample_positions")
def q_sample_positions(spark, sf_dir):
    p = _plan(spark, sf_dir).where(F.col("_chosen").isNotNull())
    return p.select("sentence", F.array_join(F.col("_chosen").cast("array<string>"), " ").alias("positions"))


@query("mark_words")
def q_mark_words(spark, sf_dir):
    p = _plan(spark, sf_dir).where(F.col("_chosen").isNotNull())
    m = TY.mark_words(F.col("_words"), F.col("_chosen"), LABEL.head_mark, LABEL.tail_mark)
    return p.select("sentence", T.join_words(m).alias("marked"))


@query("label_sentence")
def q_label_sentence(spark, sf_dir):
    return L.label_rows(all_sentences(spark, sf_dir), "sentence", LABEL)


@query("fan_out")
def q_fan_out(spark, sf_dir):
    rows = L.label_rows(all_sentences(spark, sf_dir), "sentence", LABEL)
    return rows.groupBy("sentence", "task").agg(F.count(F.lit(1)).alias("n_rows"))


@query("union_tasks")
def q_union_tasks(spark, sf_dir):
    # both branches read the sentences, which are prepared once
    rows = L.label_rows(stored_sentences(spark, sf_dir).select("sentence"), "sentence", LABEL)
    both = L.union_rows(rows.where(F.col("task") == L.DETECT), rows.where(F.col("task") == L.CORRECT))
    return both.groupBy("task").agg(F.count(F.lit(1)).alias("n_rows"))


@query("task_tag")
def q_task_tag(spark, sf_dir):
    rows = L.tag_tasks(L.label_rows(all_sentences(spark, sf_dir), "sentence", LABEL), LABEL)
    return rows.select("sentence", "task", "input")


@query("count_tokens")
def q_count_tokens(spark, sf_dir):
    rows = L.tag_tasks(L.label_rows(all_sentences(spark, sf_dir), "sentence", LABEL), LABEL)
    return rows.select("input", T.count_tokens(F.col("input")).alias("num_tokens"))


@query("token_budget")
def q_token_budget(spark, sf_dir):
    rows = L.label_rows(split_sentences_all(spark, sf_dir), "sentence", LABEL, keep=[SP.SPLIT])
    return L.budget_tokens(L.tag_tasks(rows, LABEL), BUDGET).select(*L.LABEL_COLUMNS, SP.SPLIT)


@query("label_dataset")
def q_label_dataset(spark, sf_dir):
    return L.label_sentences(split_sentences_all(spark, sf_dir), "sentence", LABEL, keep=[SP.SPLIT])


# ---------------------------------------------------------------- JOB4 parts

from ..operators import encode as EN  # noqa: E402

MAX_LENGTH = 128
EVAL_BATCH = 100


def split_sentences(spark, sf_dir, role) -> DataFrame:
    return SP.split_filter(split_table(spark, sf_dir), roles(), role, "sentence")


@step
def train_vocabulary(spark, sf_dir) -> DataFrame:
    return EN.vocabulary(split_sentences(spark, sf_dir, SP.TRAIN), "sentence")


@step
def train_index(spark, sf_dir):
    """The training vocabulary as an index for the workers, None if it is too large for that."""
    return EN.word_index(train_vocabulary(spark, sf_dir))


def label_stream(spark, sf_dir, role=None) -> DataFrame:
    """JOB3 output with its split, for all splits or one; not written, as labelling is
    narrow and encoding reads it once."""
    src = split_table(spark, sf_dir).select("sentence", SP.SPLIT)
    if role:
        src = src.where(F.col(SP.SPLIT) == role)
    return L.label_sentences(src, "sentence", LABEL, with_id=True, keep=[SP.SPLIT])


@step
def labeled(spark, sf_dir, role=None) -> DataFrame:
    """``label_stream`` written once (scoring reads it in several branches)."""
    return write_table(label_stream(spark, sf_dir, role), f"labeled-{role or 'all'}")


def ids_text(c) -> F.Column:
    return F.array_join(c.cast("array<string>"), " ")


def encoded_pairs(spark, sf_dir, role=None) -> DataFrame:
    lab = label_stream(spark, sf_dir, role).select(L.EXAMPLE_ID, SP.SPLIT, "input", "output")
    return EN.encode_texts(lab, {"input": "in_ids", "output": "out_ids"}, train_vocabulary(spark, sf_dir),
                           train_index(spark, sf_dir))


@query("vocabulary")
def q_vocabulary(spark, sf_dir):
    return train_vocabulary(spark, sf_dir)


@query("vocab_encode_join")
def q_vocab_encode_join(spark, sf_dir):
    lab = label_stream(spark, sf_dir).select(L.EXAMPLE_ID, "input")
    enc = EN.encode_texts(lab, {"input": "ids"}, train_vocabulary(spark, sf_dir), train_index(spark, sf_dir))
    return enc.select(L.EXAMPLE_ID, ids_text(F.col("ids")).alias("input_ids"))


def _fixed(spark, sf_dir):
    lab = label_stream(spark, sf_dir).select(L.EXAMPLE_ID, SP.SPLIT, "input", "output")
    e = EN.encode_dataset(lab, L.EXAMPLE_ID, train_vocabulary(spark, sf_dir), MAX_LENGTH, train_index(spark, sf_dir))
    return e.select(L.EXAMPLE_ID, SP.SPLIT, ids_text(F.col("input_ids")).alias("input_ids"),
                    ids_text(F.col("attention_mask")).alias("attention_mask"),
                    ids_text(F.col("labels")).alias("labels"))


@query("encode_fixed")
def q_encode_fixed(spark, sf_dir):
    return _fixed(spark, sf_dir).drop(SP.SPLIT)


@query("encode_dataset")
def q_encode_dataset(spark, sf_dir):
    """JOB4: train, validation and test rows, with the training vocabulary."""
    return _fixed(spark, sf_dir)


@query("encode_longest")
def q_encode_longest(spark, sf_dir):
    pairs = write_table(encoded_pairs(spark, sf_dir, SP.TEST), "encoded-pairs")  # numbered by a range shuffle next
    e = EN.encode_longest(pairs, "in_ids", "out_ids", [F.col(L.EXAMPLE_ID)],
                          EVAL_BATCH)
    return e.select(L.EXAMPLE_ID, "batch", ids_text(F.col("input_ids")).alias("input_ids"),
                    ids_text(F.col("attention_mask")).alias("attention_mask"),
                    ids_text(F.col("labels")).alias("labels"))


# ------------------------------------------------------ correction parts

from ..functions import correct as FC  # noqa: E402
from ..functions import edit as ED  # noqa: E402
from ..operators import correct as CO  # noqa: E402
from ..operators import score as SC  # noqa: E402

CORRECT = CO.CorrectConfig()
LONG_WORD = 8
N_PROMPT = len(LABEL.detect_prompt.split(" "))


@query("edit_distance")
def q_edit_distance(spark, sf_dir):
    t = q_generate_typo(spark, sf_dir)
    return t.select("doc_id", "sentence_pos", "word_pos",
                    ED.edit_distance(F.col("word"), F.col("typo")).alias("distance"))


@query("edit_gate")
def q_edit_gate(spark, sf_dir):
    st = sentence_table(spark, sf_dir)
    w = st.select("doc_id", "sentence_pos", T.split_words(F.col("sentence")).alias("ws"))
    pairs = w.select("doc_id", "sentence_pos", "ws",
                     F.explode(F.sequence(F.lit(0), F.size("ws") - 2)).alias("word_pos"))
    a, b = F.get(F.col("ws"), F.col("word_pos")), F.get(F.col("ws"), F.col("word_pos") + 1)
    pairs = pairs.select("doc_id", "sentence_pos", "word_pos", a.alias("a"), b.alias("b"))
    pairs = pairs.where(TY.valid_word(F.col("a"), LABEL.min_num_characters)
                        & TY.valid_word(F.col("b"), LABEL.min_num_characters))
    return pairs.select("doc_id", "sentence_pos", "word_pos",
                        ED.within_distance(F.col("a"), F.col("b"), CORRECT.max_edit_distance).alias("accepted"))


@step
def labeled_rows(spark, sf_dir) -> DataFrame:
    return L.label_rows(split_table(spark, sf_dir), "sentence", LABEL, with_id=True)


@query("strip_prompt_words")
def q_strip_prompt_words(spark, sf_dir):
    lab = label_stream(spark, sf_dir)
    return lab.select(L.EXAMPLE_ID, T.strip_prompt_words(F.col("input"), LABEL.detect_prompt).alias("stripped"))


@query("extract_marked")
def q_extract_marked(spark, sf_dir):
    rows = labeled_rows(spark, sf_dir).where(F.col("task") == L.CORRECT)
    ex = T.extract_marked(F.col("output"), LABEL.head_mark, LABEL.tail_mark)
    return rows.select(L.EXAMPLE_ID, F.array_join(ex, "|").alias("corrections"))


def _detect_pairs(spark, sf_dir):
    rows = labeled_rows(spark, sf_dir).where((F.col("task") == L.DETECT) & (F.col("input") != F.col("output")))
    return rows.select(L.EXAMPLE_ID,
                       T.split_words(T.add_prompt(LABEL.detect_prompt, F.col("input"))).alias("dw"),
                       T.split_words(F.col("output")).alias("mw"))


def _locate(spark, sf_dir, mode):
    p = _detect_pairs(spark, sf_dir)
    idx = FC.locate_marked(F.col("dw"), F.col("mw"), LABEL.head_mark, LABEL.tail_mark, N_PROMPT, mode)
    return p.select(L.EXAMPLE_ID, F.array_join(idx.cast("array<string>"), " ").alias("positions"))


@query("locate_marked")
def q_locate_marked(spark, sf_dir):
    return _locate(spark, sf_dir, "position")


@query("locate_marked_pair")
def q_locate_marked_pair(spark, sf_dir):
    return _locate(spark, sf_dir, "pair")


@query("apply_corrections")
def q_apply_corrections(spark, sf_dir):
    """The labels play detector and corrector: detect row gives the marks,
    the matching correct row (same copy) gives the corrections."""
    rows = labeled_rows(spark, sf_dir)
    pair_key = F.regexp_extract(F.col(L.EXAMPLE_ID), "^(.*):[01]$", 1)
    d = rows.where((F.col("task") == L.DETECT) & (F.col("input") != F.col("output"))).select(
        pair_key.alias("pair_id"), F.col("input").alias("d_in"), F.col("output").alias("d_out"))
    c = rows.where(F.col("task") == L.CORRECT).select(pair_key.alias("pair_id"), F.col("output").alias("c_out"))
    j = d.join(c, "pair_id")
    dw = T.split_words(T.add_prompt(LABEL.detect_prompt, F.col("d_in")))
    idx = FC.locate_marked(dw, T.split_words(F.col("d_out")), LABEL.head_mark, LABEL.tail_mark, N_PROMPT)
    corr = T.extract_marked(F.col("c_out"), LABEL.head_mark, LABEL.tail_mark)
    applied = FC.apply_corrections(dw, idx, corr, CORRECT.max_edit_distance)
    out = T.join_words(F.slice(applied, N_PROMPT + 1, F.greatest(F.size(applied) - N_PROMPT, F.lit(0))))
    return j.select("pair_id", out.alias("corrected"))


def conversation_texts(spark, sf_dir) -> DataFrame:
    conv = spread(read_table(spark, sf_dir, "conversations"))
    return conv.select(F.concat_ws(":", "conv_id", "turn").alias("id"), "conv_id", "turn", "text")


def conversation_words(spark, sf_dir) -> DataFrame:
    c = conversation_texts(spark, sf_dir)
    return c.select("id", F.posexplode(T.split_words(T.typeset_clean(F.col("text")))).alias("pos", "word"))


def _unknown_and_targets(spark, sf_dir):
    voc = train_vocabulary(spark, sf_dir)
    words = conversation_words(spark, sf_dir).select("word").distinct().where(
        TY.valid_word(F.col("word"), CORRECT.min_num_characters))
    unknown = words.join(voc.select("word"), "word", "left_anti")
    targets = voc.where(TY.valid_word(F.col("word"), CORRECT.min_num_characters))
    return unknown, targets, voc


@query("fuzzy_vocab_join")
def q_fuzzy_vocab_join(spark, sf_dir):
    unknown, targets, _ = _unknown_and_targets(spark, sf_dir)
    return CO.fuzzy_vocab_join(unknown, "word", targets, "word", CO.join_distance(CORRECT), "cand")


@query("best_candidate")
def q_best_candidate(spark, sf_dir):
    unknown, targets, voc = _unknown_and_targets(spark, sf_dir)
    pairs = CO.fuzzy_vocab_join(unknown, "word", targets, "word", CO.join_distance(CORRECT), "cand")
    return CO.best_candidate(pairs, "word", "cand", voc)


@query("vocab_corrector")
def q_vocab_corrector(spark, sf_dir):
    return CO.word_corrections(conversation_words(spark, sf_dir), "word", train_vocabulary(spark, sf_dir), CORRECT)


@query("correct_text")
def q_correct_text(spark, sf_dir):
    c = conversation_texts(spark, sf_dir)
    out = CO.correct_table(c, "id", "text", train_vocabulary(spark, sf_dir), CORRECT)
    return out.select("conv_id", "turn", "corrected")


class MarkLongWords(SC.Predictor):
    """A stand-in detector: marks words of at least ``LONG_WORD`` ASCII letters."""

    def predict(self, texts):
        def mark(w):
            long = len(w) >= LONG_WORD and w.isascii() and w.isalpha()
            return f"{CORRECT.head_mark} {w} {CORRECT.tail_mark}" if long else w

        return [None if t is None else " ".join(map(mark, t.split(" ")[N_PROMPT:])) for t in texts]


class DropLastLetter(SC.Predictor):
    """A stand-in corrector: drops the last letter of every marked word."""

    def predict(self, texts):
        out = []
        for t in texts:
            ws = (t or "").split(" ")[N_PROMPT:]
            out.append(" ".join(w[:-1] if 0 < i < len(ws) - 1 and ws[i - 1] == CORRECT.head_mark
                                and ws[i + 1] == CORRECT.tail_mark else w for i, w in enumerate(ws)))
        return out


@query("correct_text_predictor")
def q_correct_text_predictor(spark, sf_dir):
    """M2/JOB6 with a user's models (deterministic stand-ins here)."""
    c = conversation_texts(spark, sf_dir)
    out = CO.correct_with_models(c, "text", MarkLongWords, DropLastLetter, CORRECT)
    return out.select("conv_id", "turn", "corrected")


@query("correct_table")
def q_correct_table(spark, sf_dir):
    """JOB6 on the typo sentences of every split, serving variant (no cleaning)."""
    rows = labeled_rows(spark, sf_dir).where((F.col("task") == L.DETECT))
    cfg = CO.CorrectConfig(clean=False)
    out = CO.correct_table(rows.select(L.EXAMPLE_ID, "input"), L.EXAMPLE_ID, "input",
                           train_vocabulary(spark, sf_dir), cfg)
    return out.select(L.EXAMPLE_ID, "corrected")


# ------------------------------------------------------ scoring parts

STOP_SHARE = 20  # stop list = tokens that occur at least once in 20 sentences, on average


@step
def predictions(spark, sf_dir) -> DataFrame:
    """Test rows with M3 predictions and encoded prediction / output ids,
    written once: the batch numbering after it range-partitions, and its key
    sampling would otherwise run the whole prediction chain a second time."""
    lab = labeled(spark, sf_dir, SP.TEST).select(L.EXAMPLE_ID, "task", "input", "output")
    voc = train_vocabulary(spark, sf_dir)
    pred = SC.vocab_predict(lab, L.EXAMPLE_ID, "input", "task", voc, CORRECT)
    x = EN.encode_columns(pred, L.EXAMPLE_ID, {"prediction": "pred_ids", "output": "out_ids"}, voc, train_index(spark, sf_dir))
    return write_table(x.select(L.EXAMPLE_ID, "task", "pred_ids", "out_ids"), "predictions")


def test_labels(spark, sf_dir) -> DataFrame:
    return labeled(spark, sf_dir, SP.TEST).select(L.EXAMPLE_ID, "task", "input", "output")


def scored(spark, sf_dir) -> DataFrame:
    """M4: predictions of the vocabulary corrector, pad marker 0."""
    return SC.score_test_set(test_labels(spark, sf_dir), L.EXAMPLE_ID, train_vocabulary(spark, sf_dir), CORRECT,
                             MAX_LENGTH).select(L.EXAMPLE_ID, "task", "correct")


@query("batch_predict")
def q_batch_predict(spark, sf_dir):
    lab = label_stream(spark, sf_dir).select(L.EXAMPLE_ID, "input")
    out = SC.batch_predict(lab, "input", lambda: SC.StripPromptPredictor(N_PROMPT))
    return out.select(L.EXAMPLE_ID, "results")


@query("exact_match")
def q_exact_match(spark, sf_dir):
    """A1 with 4_train semantics: fixed padding, labels' pad marker -100."""
    p = predictions(spark, sf_dir)
    enc = EN.encode_fixed(p.select(L.EXAMPLE_ID, "pred_ids", "out_ids").withColumn("_p", F.col("pred_ids")),
                          "_p", "out_ids", MAX_LENGTH)
    gen = SC.generated_ids(F.col("pred_ids"), MAX_LENGTH)
    return enc.select(L.EXAMPLE_ID, SC.exact_match(gen, F.col("labels"), EN.LABEL_PAD).alias("correct"))


@query("score_test_set")
def q_score_test_set(spark, sf_dir):
    return scored(spark, sf_dir)


@query("accuracy")
def q_accuracy(spark, sf_dir):
    return SC.accuracy(scored(spark, sf_dir), "correct", ["task"])


@query("evaluate_dataset")
def q_evaluate_dataset(spark, sf_dir):
    return SC.evaluate_dataset(test_labels(spark, sf_dir), L.EXAMPLE_ID, train_vocabulary(spark, sf_dir), CORRECT, MAX_LENGTH)


def weighted_events(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", "value", (F.col("event_id") % 4 + 1).alias("n"))


@query("weighted_mean")
def q_weighted_mean(spark, sf_dir):
    return SC.weighted_mean(weighted_events(spark, sf_dir), "value", "n", ["event_type"])


@query("running_weighted_mean")
def q_running_weighted_mean(spark, sf_dir):
    ev = weighted_events(spark, sf_dir)
    out = SC.running_weighted_mean(ev, "value", "n", "event_type", "event_id")
    return out.select("event_id", "event_type", "running_mean")


@step
def stop_words_frame(spark, sf_dir) -> DataFrame:
    """Derived stop list: the tokens of the sentence table with at least one
    occurrence per ``STOP_SHARE`` sentences, written as a stop-word file and
    scanned back (S5)."""
    st = stored_sentences(spark, sf_dir)  # read for its tokens and for its count
    tok = st.select(F.explode(EN.tokens(F.col("sentence"))).alias("word"))
    n = st.agg(F.count(F.lit(1)).alias("n"))  # one row
    top = tok.groupBy("word").agg(F.count(F.lit(1)).alias("freq")).join(F.broadcast(n)).where(
        F.col("freq") * STOP_SHARE >= F.col("n"))
    path = scratch_path(spark, "stop-words")
    IO.write_lines(top, "word", path)
    return IO.read_stop_words(spark, path)


@query("stop_word_scan")
def q_stop_word_scan(spark, sf_dir):
    return stop_words_frame(spark, sf_dir)


@query("stop_word_anti_join")
def q_stop_word_anti_join(spark, sf_dir):
    w = valid_words(spark, sf_dir, stored_sentences(spark, sf_dir)).select("doc_id", "sentence_pos", "word_pos", "word")
    return CO.stop_word_anti_join(w, "word", stop_words_frame(spark, sf_dir))


@query("prompt_config")
def q_prompt_config(spark, sf_dir):
    path = scratch_path(spark, "prompt-config")
    IO.write_prompt_config(spark, path, LABEL.prompt_config())
    cfg = IO.read_prompt_config(spark, path)
    st = split_sentences_all(spark, sf_dir)
    return st.select("sentence", SP.SPLIT, T.add_prompt(cfg["detect_prompt"], F.col("sentence")).alias("input"))


# ------------------------------------------------------ streaming

from ..streaming import correct_stream as CS  # noqa: E402


@query("stream_correct")
def q_stream_correct(spark, sf_dir):
    """ST1 over the conversations file as a stream; equals ``correct_text``."""
    conv = read_table(spark, sf_dir, "conversations")
    voc = CS.materialize(train_vocabulary(spark, sf_dir), scratch_path(spark, "vocabulary"))
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    src = conv.select("conv_id", "turn", "text")
    keyed_schema = src.schema
    # the table itself is the source: a folder of files, or one file, which a stream takes from its folder
    source = table_path(sf_dir, "conversations")
    folder, name = source.rsplit("/", 1)
    one_file = [f.endswith(f"/{name}") and not f.endswith(f"/{name}/{name}") for f in conv.inputFiles()] == [True]
    CS.stream_correct(spark, folder if one_file else source, keyed_schema, "id", "text", voc, sink, ckpt, CORRECT,
                      keep_cols=("conv_id", "turn"), glob=name if one_file else None,
                      id_expr=F.concat_ws(":", "conv_id", "turn"))
    return spark.read.parquet(sink).select("conv_id", "turn", "corrected")
