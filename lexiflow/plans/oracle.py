"""DuckDB SQL for each registered query (same names, same output columns)."""

from __future__ import annotations

from . import sql_text as S
from .catalog import CUSTOM_HEADER

ORACLE: dict[str, str] = {}


def cleaned_cte() -> str:
    return (f"cleaned AS (SELECT doc_id, lang, source, n_chars, {S.typeset_clean('text')} AS text "
            f"FROM documents)")


def explode_cte(src: str, name: str = "sents") -> str:
    """Sentence rows of ``src`` (doc_id, lang, source, n_chars, text)."""
    return (f"{name}_arr AS (SELECT doc_id, lang, source, n_chars, {S.segment_sentence('text')} AS s "
            f"FROM {src}), "
            f"{name} AS (SELECT doc_id, lang, source, n_chars, "
            f"CAST(unnest(range(len(s))) AS INTEGER) AS sentence_pos, unnest(s) AS sentence "
            f"FROM {name}_arr)")


def sentence_table_ctes() -> str:
    """CTEs ending in ``st``: the JOB1 output (doc_id, lang, source, n_chars, sentence_pos, sentence)."""
    return (
        "nn AS (SELECT * FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL "
        "AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL), "
        f"cl AS (SELECT doc_id, lang, source, n_chars, {S.typeset_clean('text')} AS text FROM nn), "
        f"sec AS (SELECT doc_id, lang, source, n_chars, {S.extract_section('text')} AS text FROM cl), "
        + explode_cte("sec", "ex") + ", "
        f"st AS (SELECT doc_id, lang, source, n_chars, sentence_pos, sentence FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {S.content_key('sentence')} "
        f"ORDER BY doc_id, sentence_pos) AS rn FROM ex) WHERE rn = 1)"
    )


ORACLE["newline_to_space"] = (
    f"SELECT doc_id, {S.newline_to_space('text')} AS text_out FROM documents")

ORACLE["typeset_clean"] = f"WITH {cleaned_cte()} SELECT doc_id, text AS cleaned FROM cleaned"

ORACLE["extract_section"] = (
    f"WITH {cleaned_cte()} SELECT doc_id, {S.extract_section('text')} AS section FROM cleaned")

ORACLE["extract_section_custom"] = (
    f"WITH {cleaned_cte()} SELECT doc_id, {S.extract_section('text', CUSTOM_HEADER)} AS section "
    f"FROM cleaned")

ORACLE["segment_sentence"] = (
    f"WITH {cleaned_cte()}, seg AS (SELECT doc_id, {S.segment_sentence('text')} AS s FROM cleaned) "
    f"SELECT doc_id, CAST(len(s) AS INTEGER) AS n_sentences, array_to_string(s, chr(10)) AS sentences "
    f"FROM seg")

ORACLE["explode_sentences"] = (
    f"WITH {cleaned_cte()}, {explode_cte('cleaned')} SELECT * FROM sents")

ORACLE["content_key"] = (
    f"WITH {cleaned_cte()}, {explode_cte('cleaned')} "
    f"SELECT doc_id, sentence_pos, {S.content_key('sentence')} AS content FROM sents")

ORACLE["drop_null_rows"] = (
    "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id "
    "WHERE d.doc_id IS NOT NULL AND d.lang IS NOT NULL AND d.source IS NOT NULL "
    "AND d.n_chars IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL")

ORACLE["prune_columns"] = (
    f"WITH {cleaned_cte()}, {explode_cte('cleaned')} "
    f"SELECT doc_id, lang, source, sentence_pos, sentence FROM sents")

ORACLE["dedup_keep_first"] = (
    "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY "
    f"{S.content_key('text')} ORDER BY conv_id, turn) AS rn FROM conversations) WHERE rn = 1")

ORACLE["prepare_sentences"] = f"WITH {sentence_table_ctes()} SELECT * FROM st"


# ---------------------------------------------------------------- JOB2 parts

from .catalog import SEED  # noqa: E402


def split_ctes(seed: int = SEED, k: int = 10, n_train: int = 7, n_val: int = 1) -> str:
    """CTEs ending in ``sp``: sentence table + fold + split."""
    h = S.draw_hash(seed, "'folds'", "fold", "i")
    return (
        sentence_table_ctes() + ", "
        "firsts AS (SELECT source, doc_id AS fd, sentence_pos AS fp FROM (SELECT source, doc_id, "
        "sentence_pos, row_number() OVER (PARTITION BY source ORDER BY doc_id, sentence_pos) AS rn "
        "FROM st) WHERE rn = 1), "
        "cnt AS (SELECT source, count(*) AS cn FROM st GROUP BY source), "
        "cls AS (SELECT c.source, c.cn, coalesce(sum(c.cn) OVER (ORDER BY f.fd, f.fp ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM cnt c JOIN firsts f USING (source)), "
        f"q AS (SELECT source, i, ceil((a + cn - i) / {k}.0) - ceil((a - i) / {k}.0) AS quota "
        f"FROM cls, range({k}) t(i)), "
        "cq AS (SELECT source, i, sum(quota) OVER (PARTITION BY source ORDER BY i) AS cum FROM q), "
        "rk AS (SELECT st.*, row_number() OVER (PARTITION BY source ORDER BY doc_id, sentence_pos) - 1 "
        "AS r FROM st), "
        "folded AS (SELECT rk.*, CAST((SELECT count(*) FROM cq WHERE cq.source = rk.source AND "
        "cq.cum <= rk.r) AS INTEGER) AS fold FROM rk), "
        f"roles AS (SELECT CAST(i AS INTEGER) AS fold, CASE WHEN rk <= {n_train} THEN 'train' "
        f"WHEN rk <= {n_train + n_val} THEN 'validation' ELSE 'test' END AS split FROM ("
        f"SELECT i, row_number() OVER (ORDER BY {S.md5_word(h)}, i) AS rk FROM range({k}) t(i))), "
        "sp AS (SELECT folded.*, roles.split FROM folded JOIN roles USING (fold))"
    )


ORACLE["class_counts"] = (
    f"WITH {sentence_table_ctes()} SELECT source, count(*) AS n_rows FROM st GROUP BY source")

ORACLE["stratified_kfold"] = (
    f"WITH {split_ctes()} SELECT doc_id, sentence_pos, source, fold FROM sp")

ORACLE["fold_roles"] = (
    f"WITH {split_ctes()} SELECT fold, split, count(*) AS n_rows FROM sp GROUP BY fold, split")

ORACLE["split_dataset"] = (
    f"WITH {split_ctes()} SELECT doc_id, sentence_pos, source, fold, split, sentence FROM sp")

ORACLE["split_filter"] = f"WITH {split_ctes()} SELECT sentence FROM sp WHERE split = 'test'"

ORACLE["remaining_folds"] = (
    f"WITH {split_ctes()} SELECT fold, count(*) AS n_rows FROM sp "
    "WHERE split NOT IN ('train', 'validation') GROUP BY fold")

ORACLE["line_sink"] = f"WITH {split_ctes()} SELECT split, sentence AS line FROM sp"

ORACLE["line_scan"] = (
    f"WITH {split_ctes()} SELECT split, {S.strip_space('sentence')} AS sentence FROM sp")

ORACLE["csv_sink"] = f"WITH {sentence_table_ctes()} SELECT * FROM st"

ORACLE["csv_scan"] = "SELECT * FROM documents"

ORACLE["csv_scan_split"] = "SELECT * FROM documents"


# ---------------------------------------------------------------- JOB3 parts

from ..functions.draw import threshold  # noqa: E402
from ..functions.typo import ALPHABET  # noqa: E402
from . import sql_label as SL  # noqa: E402
from .catalog import BUDGET, LABEL  # noqa: E402


def valid_words_ctes() -> str:
    return (sentence_table_ctes() + ", "
            "vw0 AS (SELECT doc_id, sentence_pos, md5(sentence) AS key, string_split(sentence, ' ') AS ws "
            "FROM st), "
            "vw1 AS (SELECT doc_id, sentence_pos, key, CAST(unnest(range(len(ws))) AS INTEGER) AS word_pos, "
            "unnest(ws) AS word FROM vw0), "
            f"vw AS (SELECT * FROM vw1 WHERE {SL.valid_word('word', LABEL.min_num_characters)})")


def _char_sql(op: str) -> str:
    hh = S.draw_hash(LABEL.seed, "key", "probe", "word_pos")
    n = "CAST(length(word) AS BIGINT)"
    pos = f"({S.scaled(S.md5_word(hh, 1), n)})"
    pos_s = f"({S.scaled(S.md5_word(hh, 1), n + ' - 1')})"
    ch = f"substr('{ALPHABET}', CAST({S.scaled(S.md5_word(hh, 2), '26')} AS INTEGER) + 1, 1)"
    res = {
        "insert": f"substr(word, 1, {pos}) || {ch} || substr(word, {pos} + 1)",
        "remove": f"substr(word, 1, {pos}) || substr(word, {pos} + 2)",
        "replace": f"substr(word, 1, {pos}) || {ch} || substr(word, {pos} + 2)",
        "swap": f"substr(word, 1, {pos_s}) || substr(word, {pos_s} + 2, 1) || "
                f"substr(word, {pos_s} + 1, 1) || substr(word, {pos_s} + 3)",
    }[op]
    return f"WITH {valid_words_ctes()} SELECT doc_id, sentence_pos, word_pos, word, {res} AS result FROM vw"


for _op, _key in (("insert", "insert_char"), ("remove", "remove_char"), ("replace", "replace_char"),
                  ("swap", "swap_adjacent")):
    ORACLE[_key] = _char_sql(_op)

ORACLE["generate_typo"] = (
    f"WITH {valid_words_ctes()} SELECT doc_id, sentence_pos, word_pos, word, "
    f"{SL.generate_typo('word', LABEL.seed, 'key', '0', 'word_pos')} AS typo FROM vw")

ORACLE["valid_word"] = (
    f"WITH {sentence_table_ctes()} SELECT doc_id, sentence_pos, "
    "CAST(len(string_split(sentence, ' ')) AS INTEGER) AS n_words, "
    f"CAST(len(list_filter(string_split(sentence, ' '), lambda lw: "
    f"{SL.valid_word('lw', LABEL.min_num_characters)})) AS INTEGER) AS n_valid FROM st")

ORACLE["split_words"] = (
    f"WITH {sentence_table_ctes()} SELECT doc_id, sentence_pos, "
    "CAST(len(string_split(sentence, ' ')) AS INTEGER) AS n_words FROM st")

ORACLE["join_words"] = (
    f"WITH {sentence_table_ctes()} SELECT doc_id, sentence_pos, "
    "array_to_string(string_split(sentence, ' '), ' ') AS rejoined FROM st")

ORACLE["add_prompt"] = (
    f"WITH {sentence_table_ctes()} SELECT doc_id, sentence_pos, "
    f"{S.add_prompt(LABEL.detect_prompt, 'sentence')} AS input FROM st")

ORACLE["min_sentence_length"] = (
    f"WITH {sentence_table_ctes()} SELECT doc_id, sentence_pos, sentence FROM st "
    "WHERE length(sentence) >= 5")

_SEL = S.draw_hash(LABEL.seed, "md5(sentence)", "sel")
ORACLE["portable_draw"] = (
    f"WITH {sentence_table_ctes()} SELECT sentence, "
    + ", ".join(f"{S.md5_word(_SEL, k)} AS u{k}" for k in range(4)) + " FROM st")

ORACLE["bernoulli_rows"] = (
    f"WITH {sentence_table_ctes()} SELECT sentence FROM st "
    f"WHERE {S.md5_word(_SEL, 0)} < {threshold(LABEL.typo_probability)}")

_PLAN = f"WITH {sentence_table_ctes()}, {SL.plan_ctes('st', LABEL)} "
ORACLE["weighted_count"] = (
    _PLAN + "SELECT sentence, CAST(len(chosen) AS INTEGER) AS num_typo FROM lab_plan WHERE chosen IS NOT NULL")
ORACLE["sample_positions"] = (
    _PLAN + "SELECT sentence, array_to_string(chosen, ' ') AS positions FROM lab_plan WHERE chosen IS NOT NULL")
ORACLE["mark_words"] = (
    _PLAN + f"SELECT sentence, array_to_string("
    f"{SL.mark('words', 'chosen', LABEL.head_mark, LABEL.tail_mark)}, ' ') AS marked "
    "FROM lab_plan WHERE chosen IS NOT NULL")

_ROWS = f"WITH {sentence_table_ctes()}, {SL.rows_ctes('st', LABEL)} "
ORACLE["label_sentence"] = _ROWS + "SELECT sentence, task, input, output FROM lab_rows"
ORACLE["fan_out"] = _ROWS + "SELECT sentence, task, count(*) AS n_rows FROM lab_rows GROUP BY sentence, task"
ORACLE["union_tasks"] = _ROWS + "SELECT task, count(*) AS n_rows FROM lab_rows GROUP BY task"
_TAG = (f"CASE WHEN task = 0 THEN {S.add_prompt(LABEL.detect_prompt, 'input')} "
        f"ELSE {S.add_prompt(LABEL.correct_prompt, 'input')} END")
ORACLE["task_tag"] = _ROWS + f"SELECT sentence, task, {_TAG} AS input FROM lab_rows"
ORACLE["count_tokens"] = (
    _ROWS + f"SELECT input, {S.count_tokens('input')} AS num_tokens FROM "
    f"(SELECT {_TAG} AS input FROM lab_rows)")

ORACLE["token_budget"] = (
    f"WITH {split_ctes()}, {SL.dataset_ctes('sp', LABEL, keep=('split',))} "
    f"SELECT sentence, input, output, task, num_tokens, split FROM lab_all WHERE num_tokens <= {BUDGET}")
ORACLE["label_dataset"] = (
    f"WITH {split_ctes()}, {SL.dataset_ctes('sp', LABEL, keep=('split',))} "
    "SELECT sentence, input, output, task, num_tokens, split FROM lab")


# ---------------------------------------------------------------- JOB4 parts

from .catalog import EVAL_BATCH, MAX_LENGTH  # noqa: E402


def vocab_ctes() -> str:
    """After split_ctes: ``voc(word, freq, word_id)`` from the train split."""
    return ("vtok AS (SELECT unnest(list_filter(string_split(sentence, ' '), lambda lw: lw <> '')) AS word "
            "FROM sp WHERE split = 'train'), "
            "voc AS (SELECT word, count(*) AS freq, row_number() OVER (ORDER BY count(*) DESC, word) + 2 "
            "AS word_id FROM vtok GROUP BY word)")


def labeled_ctes(role: str | None = None) -> str:
    where = f" WHERE split = '{role}'" if role else ""
    return (f"{split_ctes()}, role_st AS (SELECT sentence, split FROM sp{where}), "
            f"{SL.dataset_ctes('role_st', LABEL, keep=('split',))}, {vocab_ctes()}")


def encode_cte(name: str, col: str) -> str:
    return (f"{name}_tok AS (SELECT example_id, unnest(range(len(t))) AS pos, unnest(t) AS word FROM "
            f"(SELECT example_id, list_filter(string_split({col}, ' '), lambda lw: lw <> '') AS t FROM lab)), "
            f"{name} AS (SELECT example_id, list(coalesce(word_id, 2) ORDER BY pos) AS ids "
            f"FROM {name}_tok LEFT JOIN voc USING (word) GROUP BY example_id)")


def pairs_cte() -> str:
    return (encode_cte("enc_in", "input") + ", " + encode_cte("enc_out", "output") + ", "
            "pairs AS (SELECT l.example_id, l.split, coalesce(i.ids, []) AS in_ids, coalesce(o.ids, []) AS out_ids "
            "FROM lab l LEFT JOIN enc_in i USING (example_id) LEFT JOIN enc_out o USING (example_id))")


def ids_text(e: str) -> str:
    return f"array_to_string({e}, ' ')"


ORACLE["vocabulary"] = f"WITH {split_ctes()}, {vocab_ctes()} SELECT word, freq, word_id FROM voc"

ORACLE["vocab_encode_join"] = (
    f"WITH {labeled_ctes()}, {encode_cte('enc_in', 'input')} "
    f"SELECT l.example_id, {ids_text('coalesce(i.ids, [])')} AS input_ids FROM lab l "
    "LEFT JOIN enc_in i USING (example_id)")


def fixed_sql(keep: str = "") -> str:
    m = MAX_LENGTH
    return (
        f"WITH {labeled_ctes()}, {pairs_cte()}, "
        f"f AS (SELECT example_id{keep}, list_concat(in_ids[1:{m - 1}], [1]) AS fin, "
        f"list_concat(out_ids[1:{m - 1}], [1]) AS fout FROM pairs) "
        f"SELECT example_id{keep}, {ids_text(f'list_resize(fin, {m}, 0)')} AS input_ids, "
        f"{ids_text(f'list_transform(range({m}), lambda li: CASE WHEN li < len(fin) THEN 1 ELSE 0 END)')} "
        f"AS attention_mask, "
        f"{ids_text(f'list_transform(range({m}), lambda li: CASE WHEN li < len(fout) THEN fout[li + 1] ELSE -100 END)')} "
        f"AS labels FROM f")


ORACLE["encode_fixed"] = fixed_sql()
ORACLE["encode_dataset"] = fixed_sql(", split")

ORACLE["encode_longest"] = (
    f"WITH {labeled_ctes('test')}, {pairs_cte()}, "
    f"f AS (SELECT example_id, (row_number() OVER (ORDER BY example_id) - 1) // {EVAL_BATCH} AS batch, "
    "list_concat(in_ids[1:511], [1]) AS fin, list_concat(out_ids[1:511], [1]) AS fout FROM pairs), "
    "g AS (SELECT *, max(len(fin)) OVER (PARTITION BY batch) AS lin, "
    "max(len(fout)) OVER (PARTITION BY batch) AS lout FROM f) "
    f"SELECT example_id, batch, {ids_text('list_resize(fin, lin, 0)')} AS input_ids, "
    f"{ids_text('list_transform(range(lin), lambda li: CASE WHEN li < len(fin) THEN 1 ELSE 0 END)')} "
    f"AS attention_mask, {ids_text('list_resize(fout, lout, 0)')} AS labels FROM g")


# ------------------------------------------------------ correction parts

from . import sql_correct as SC  # noqa: E402
from .catalog import CORRECT, LONG_WORD, N_PROMPT  # noqa: E402

ORACLE["edit_distance"] = (
    f"WITH {valid_words_ctes()}, t AS (SELECT doc_id, sentence_pos, word_pos, word, "
    f"{SL.generate_typo('word', LABEL.seed, 'key', '0', 'word_pos')} AS typo FROM vw) "
    f"SELECT doc_id, sentence_pos, word_pos, {SC.edit_distance('word', 'typo')} AS distance FROM t")

ORACLE["edit_gate"] = (
    f"WITH {sentence_table_ctes()}, w AS (SELECT doc_id, sentence_pos, string_split(sentence, ' ') AS ws FROM st), "
    "p AS (SELECT doc_id, sentence_pos, ws, CAST(unnest(range(len(ws) - 1)) AS INTEGER) AS word_pos FROM w), "
    "q AS (SELECT doc_id, sentence_pos, word_pos, ws[word_pos + 1] AS a, ws[word_pos + 2] AS b FROM p) "
    f"SELECT doc_id, sentence_pos, word_pos, {SC.within('a', 'b', CORRECT.max_edit_distance)} AS accepted FROM q "
    f"WHERE {SL.valid_word('a', LABEL.min_num_characters)} AND {SL.valid_word('b', LABEL.min_num_characters)}")

_LROWS = f"WITH {split_ctes()}, {SL.rows_ctes('sp', LABEL)} "

ORACLE["strip_prompt_words"] = (
    f"WITH {labeled_ctes()} SELECT example_id, "
    f"{S.strip_prompt_words('input', LABEL.detect_prompt)} AS stripped FROM lab")

ORACLE["extract_marked"] = (
    _LROWS + f"SELECT example_id, array_to_string("
    f"{S.extract_marked('output', LABEL.head_mark, LABEL.tail_mark)}, '|') AS corrections "
    "FROM lab_rows WHERE task = 1")

_DPAIRS = (_LROWS + ", dp AS (SELECT example_id, "
           f"string_split({S.add_prompt(LABEL.detect_prompt, 'input')}, ' ') AS dw, "
           "string_split(output, ' ') AS mw FROM lab_rows WHERE task = 0 AND input <> output) ")
ORACLE["locate_marked"] = (
    _DPAIRS + f"SELECT example_id, array_to_string("
    f"{SC.locate_position('mw', LABEL.head_mark, LABEL.tail_mark, N_PROMPT)}, ' ') AS positions FROM dp")
ORACLE["locate_marked_pair"] = (
    _DPAIRS + f"SELECT example_id, array_to_string("
    f"{SC.locate_pair('dw', 'mw', LABEL.head_mark, LABEL.tail_mark, N_PROMPT)}, ' ') AS positions FROM dp")

ORACLE["apply_corrections"] = (
    _LROWS + ", d AS (SELECT regexp_extract(example_id, '^(.*):[01]$', 1) AS pair_id, input AS d_in, "
    "output AS d_out FROM lab_rows WHERE task = 0 AND input <> output), "
    "c AS (SELECT regexp_extract(example_id, '^(.*):[01]$', 1) AS pair_id, output AS c_out FROM lab_rows "
    "WHERE task = 1), "
    f"j AS (SELECT pair_id, string_split({S.add_prompt(LABEL.detect_prompt, 'd_in')}, ' ') AS dw, "
    "string_split(d_out, ' ') AS mw, "
    f"{S.extract_marked('c_out', LABEL.head_mark, LABEL.tail_mark)} AS corr FROM d JOIN c USING (pair_id)), "
    f"k AS (SELECT pair_id, dw, corr, {SC.locate_position('mw', LABEL.head_mark, LABEL.tail_mark, N_PROMPT)} "
    "AS idx FROM j) "
    f"SELECT pair_id, array_to_string({SC.apply_corrections('dw', 'idx', 'corr', CORRECT.max_edit_distance)}"
    f"[{N_PROMPT + 1}:], ' ') AS corrected FROM k")


def conv_words_ctes() -> str:
    return (f"{split_ctes()}, {vocab_ctes()}, "
            f"ctext AS (SELECT conv_id || ':' || turn AS id, conv_id, turn, {S.typeset_clean('text')} AS clean "
            "FROM conversations), "
            "cw AS (SELECT id, CAST(unnest(range(len(ws))) AS INTEGER) AS pos, unnest(ws) AS word FROM "
            "(SELECT id, string_split(clean, ' ') AS ws FROM ctext)), "
            f"{SC.corrector_ctes('cw', CORRECT)}")


ORACLE["fuzzy_vocab_join"] = f"WITH {conv_words_ctes()} SELECT word, cand, distance FROM fz"
ORACLE["best_candidate"] = f"WITH {conv_words_ctes()} SELECT word, best, distance FROM best"
ORACLE["vocab_corrector"] = f"WITH {conv_words_ctes()} SELECT word, best FROM fixes"
ORACLE["correct_text"] = (
    f"WITH {conv_words_ctes()}, src AS (SELECT ctext.id, clean, coalesce(flags.flags, []) AS fl "
    f"FROM ctext LEFT JOIN flags USING (id)), {SC.chain_ctes('src', CORRECT)} "
    "SELECT conv_id, turn, corrected FROM ctext JOIN chained USING (id)")

ORACLE["correct_text_predictor"] = (
    f"SELECT conv_id, turn, array_to_string(list_transform(string_split({S.typeset_clean('text')}, ' '), "
    f"lambda lw: CASE WHEN regexp_matches(lw, '^[A-Za-z]{{{LONG_WORD},}}\\z') "
    "THEN substr(lw, 1, length(lw) - 1) ELSE lw END), ' ') AS corrected FROM conversations")

_NOCLEAN = type(CORRECT)(clean=False)
ORACLE["correct_table"] = (
    _LROWS + f", {vocab_ctes()}, "
    "det AS (SELECT example_id AS id, input AS clean FROM lab_rows WHERE task = 0), "
    "cw AS (SELECT id, CAST(unnest(range(len(ws))) AS INTEGER) AS pos, unnest(ws) AS word FROM "
    "(SELECT id, string_split(clean, ' ') AS ws FROM det)), "
    f"{SC.corrector_ctes('cw', _NOCLEAN)}, "
    "src AS (SELECT det.id, clean, coalesce(flags.flags, []) AS fl FROM det LEFT JOIN flags USING (id)), "
    f"{SC.chain_ctes('src', _NOCLEAN)} SELECT id AS example_id, corrected FROM chained")


# ------------------------------------------------------ scoring parts

from .catalog import STOP_SHARE  # noqa: E402


def encode_src_cte(name: str, src: str, id_col: str, col: str) -> str:
    return (f"{name}_tok AS (SELECT {id_col} AS eid, unnest(range(len(t))) AS pos, unnest(t) AS word FROM "
            f"(SELECT {id_col}, list_filter(string_split({col}, ' '), lambda lw: lw <> '') AS t FROM {src})), "
            f"{name} AS (SELECT eid, list(coalesce(word_id, 2) ORDER BY pos) AS ids "
            f"FROM {name}_tok LEFT JOIN voc USING (word) GROUP BY eid)")


def predict_ctes() -> str:
    """``pe(example_id, task, pred_ids, out_ids)`` for the test set with M3 predictions."""
    h, t = CORRECT.head_mark, CORRECT.tail_mark
    best_at = "list_transform(list_filter(fl, lambda fb: fb.pos = li - 1), lambda fb: fb.best)[1]"
    correct_out = (f"array_to_string(list_transform(w, lambda lw, li: CASE WHEN li - 1 > 0 AND li - 1 < len(w) - 1 "
                   f"AND w[li - 1] = {S.lit(h)} AND w[li + 1] = {S.lit(t)} THEN coalesce({best_at}, lw) "
                   f"ELSE lw END), ' ')")
    detect_out = f"array_to_string({SL.mark('w', 'list_transform(fl, lambda fs: fs.pos)', h, t)}, ' ')"
    return (
        f"{labeled_ctes('test')}, "
        f"pw AS (SELECT example_id AS id, task, output, string_split(input, ' ')[{N_PROMPT + 1}:] AS w FROM lab), "
        "cw AS (SELECT id, CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS word FROM pw), "
        f"{SC.corrector_ctes('cw', CORRECT)}, "
        "pr AS (SELECT pw.*, coalesce(flags.flags, []) AS fl FROM pw LEFT JOIN flags USING (id)), "
        f"pred AS (SELECT id, task, output, CASE WHEN task = 0 THEN {detect_out} ELSE {correct_out} END "
        "AS prediction FROM pr), "
        f"{encode_src_cte('e_pred', 'pred', 'id', 'prediction')}, {encode_src_cte('e_out', 'pred', 'id', 'output')}, "
        "pe AS (SELECT pred.id AS example_id, task, coalesce(a.ids, []) AS pred_ids, coalesce(b.ids, []) AS out_ids "
        "FROM pred LEFT JOIN e_pred a ON a.eid = pred.id LEFT JOIN e_out b ON b.eid = pred.id)"
    )


def exact_match_sql(gen: str, labels: str, pad: int) -> str:
    return (f"(len(list_filter(range(len({labels})), lambda mi: NOT ({labels}[mi + 1] = {pad} OR "
            f"coalesce({gen}[mi + 2], 0) = {labels}[mi + 1]))) = 0)")


_GEN = f"list_concat([0], pred_ids, [1])[1:{MAX_LENGTH}]"
_SCORED = (f"WITH {predict_ctes()}, sc AS (SELECT example_id, task, "
           f"{exact_match_sql(_GEN, 'list_concat(out_ids[1:511], [1])', 0)} AS correct FROM pe) ")

ORACLE["batch_predict"] = (
    f"WITH {labeled_ctes()} SELECT example_id, array_to_string(string_split(input, ' ')[{N_PROMPT + 1}:], ' ') "
    "AS results FROM lab")

_FOUT = f"list_concat(out_ids[1:{MAX_LENGTH - 1}], [1])"
ORACLE["exact_match"] = (
    f"WITH {predict_ctes()}, lb AS (SELECT example_id, pred_ids, "
    f"list_transform(range({MAX_LENGTH}), lambda li: CASE WHEN li < len({_FOUT}) THEN {_FOUT}[li + 1] "
    "ELSE -100 END) AS labels FROM pe) "
    f"SELECT example_id, {exact_match_sql(_GEN, 'labels', -100)} AS correct FROM lb")

ORACLE["score_test_set"] = _SCORED + "SELECT example_id, task, correct FROM sc"
ORACLE["accuracy"] = (
    _SCORED + "SELECT task, count(*) AS n_rows, sum(CAST(correct AS BIGINT)) AS n_correct, "
    "CAST(sum(CAST(correct AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS accuracy FROM sc GROUP BY task")
ORACLE["evaluate_dataset"] = (
    _SCORED + "SELECT count(*) AS n_rows, sum(CAST(correct AS BIGINT)) AS n_correct, "
    "CAST(sum(CAST(correct AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS accuracy FROM sc")

_EV = ("ev AS (SELECT event_id, event_type, CAST(value AS DECIMAL(18,6)) * CAST(event_id % 4 + 1 AS DECIMAL(18,0)) "
       "AS v, CAST(event_id % 4 + 1 AS DECIMAL(18,0)) AS n FROM events)")
ORACLE["weighted_mean"] = (
    f"WITH {_EV} SELECT event_type, CAST(sum(v) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS weighted_mean "
    "FROM ev GROUP BY event_type")
ORACLE["running_weighted_mean"] = (
    f"WITH {_EV} SELECT event_id, event_type, "
    "CAST(sum(v) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE) AS running_mean FROM ev "
    "WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")

_STOP_CTE = ("stop AS (SELECT word FROM (SELECT word, count(*) AS freq FROM "
             "(SELECT unnest(list_filter(string_split(sentence, ' '), lambda lw: lw <> '')) AS word FROM st) "
             f"GROUP BY word) WHERE freq * {STOP_SHARE} >= (SELECT count(*) FROM st))")
ORACLE["stop_word_scan"] = (
    f"WITH {sentence_table_ctes()}, {_STOP_CTE} SELECT {S.strip_space('word')} AS word FROM stop")
ORACLE["stop_word_anti_join"] = (
    f"WITH {valid_words_ctes()}, {_STOP_CTE} "
    "SELECT doc_id, sentence_pos, word_pos, word FROM vw WHERE word NOT IN (SELECT word FROM stop)")
ORACLE["prompt_config"] = (
    f"WITH {split_ctes()} SELECT sentence, split, {S.add_prompt(LABEL.detect_prompt, 'sentence')} AS input FROM sp")

ORACLE["stream_correct"] = ORACLE["correct_text"]
