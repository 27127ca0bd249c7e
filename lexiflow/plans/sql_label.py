"""DuckDB SQL twin of the labelling operators (same draws, same rules)."""

from __future__ import annotations

from ..functions.draw import threshold
from ..functions.typo import ALPHABET, MAX_TYPO_ATTEMPTS
from ..operators.label import MIN_SENTENCE_CHARS, LabelConfig
from . import sql_text as S


def valid_word(w: str, min_chars: int, stop=()) -> str:
    cond = f"(regexp_matches({w}, '^[A-Za-z]+\\z') AND length({w}) >= {min_chars}"
    if stop:
        cond += f" AND NOT list_contains([{', '.join(S.lit(x) for x in stop)}], {w})"
    return cond + ")"


def candidate(w: str, hh: str) -> str:
    n = f"CAST(length({w}) AS BIGINT)"
    u0, u1, u2 = (S.md5_word(hh, k) for k in range(3))
    kind = S.scaled(u0, "4")
    pos = f"({S.scaled(u1, n)})"
    pos_s = f"({S.scaled(u1, n + ' - 1')})"
    ch = f"substr('{ALPHABET}', CAST({S.scaled(u2, '26')} AS INTEGER) + 1, 1)"
    return (f"(CASE {kind} "
            f"WHEN 0 THEN substr({w}, 1, {pos}) || {ch} || substr({w}, {pos} + 1) "
            f"WHEN 1 THEN substr({w}, 1, {pos}) || substr({w}, {pos} + 2) "
            f"WHEN 2 THEN substr({w}, 1, {pos}) || {ch} || substr({w}, {pos} + 2) "
            f"ELSE substr({w}, 1, {pos_s}) || substr({w}, {pos_s} + 2, 1) || substr({w}, {pos_s} + 1, 1) "
            f"|| substr({w}, {pos_s} + 3) END)")


def generate_typo(w: str, seed: int, key: str, copy: str, index: str) -> str:
    def first(a: int, z: int) -> str:
        cands = (f"list_transform(range({a}, {z}), lambda la: "
                 f"{candidate(w, S.draw_hash(seed, key, 'typo', copy, index, 'la'))})")
        return f"list_filter({cands}, lambda lx: lx <> {w})[1]"

    return f"coalesce({first(1, 11)}, {first(11, MAX_TYPO_ATTEMPTS + 1)})"


def mark(words: str, chosen: str, head: str, tail: str) -> str:
    return (f"list_transform({words}, lambda lm, lj: CASE WHEN list_contains({chosen}, lj - 1) "
            f"THEN {S.lit(head + ' ')} || lm || {S.lit(' ' + tail)} ELSE lm END)")


def plan_ctes(src: str, cfg: LabelConfig, text: str = "sentence", keep: tuple = ()) -> str:
    """CTEs ending in ``lab_plan(sentence, key, words, chosen, *keep)``."""
    kc = "".join(f", {c}" for c in keep)
    cw = cfg.cumulative_weights()
    cw_sql = "[" + ", ".join(str(c) for c in cw) + "]"
    sel = f"{S.md5_word(S.draw_hash(cfg.seed, 'key', 'sel'))} < {threshold(cfg.typo_probability)}"
    kmax = f"greatest(least({cfg.max_num_typo}, len(vidx)), 1)"
    total = f"CAST({cw_sql}[{kmax}] AS BIGINT)"
    t = S.scaled(S.md5_word(S.draw_hash(cfg.seed, "key", "cnt")), total)
    k = f"(len(list_filter({cw_sql}[1:{kmax} - 1], lambda lc: lc <= ({t}))) + 1)"
    pos_d = S.md5_word(S.draw_hash(cfg.seed, "key", "pos", "lv"))
    chosen = (f"list_transform(list_sort(list_transform(vidx, lambda lv: {{'d': {pos_d}, 'i': lv}}))"
              f"[1:{k}], lambda ls: ls.i)")
    return (
        f"lab_base AS (SELECT {text} AS sentence, md5({text}) AS key, string_split({text}, ' ') AS words{kc} "
        f"FROM {src} WHERE length({text}) >= {MIN_SENTENCE_CHARS}), "
        f"lab_valid AS (SELECT *, list_filter(range(len(words)), lambda lq: "
        f"{valid_word('words[lq + 1]', cfg.min_num_characters, tuple(cfg.stop_words))}) AS vidx "
        f"FROM lab_base), "
        f"lab_plan AS (SELECT sentence, key, words, CASE WHEN {sel} AND len(vidx) > 0 THEN {chosen} END "
        f"AS chosen{kc} FROM lab_valid)"
    )


def rows_ctes(src: str, cfg: LabelConfig, text: str = "sentence", keep: tuple = ()) -> str:
    """CTEs ending in ``lab_rows(sentence, task, input, output, *keep)``."""
    kc = "".join(f", {c}" for c in keep)
    typo = (f"list_transform(words, lambda lw, li: CASE WHEN list_contains(chosen, li - 1) THEN "
            f"{generate_typo('lw', cfg.seed, 'key', 'copy', 'li - 1')} ELSE lw END)")
    h, t = cfg.head_mark, cfg.tail_mark
    return (
        plan_ctes(src, cfg, text, keep) + ", "
        f"lab_copy AS (SELECT sentence, key, words, chosen, unnest(range({cfg.data_multiple})) AS copy{kc} "
        f"FROM lab_plan WHERE chosen IS NOT NULL), "
        f"lab_typo AS (SELECT sentence, key, copy, words, chosen, {typo} AS typo{kc} FROM lab_copy), "
        f"lab_mark AS (SELECT sentence, key, copy, array_to_string(typo, ' ') AS typo_s, "
        f"array_to_string({mark('typo', 'chosen', h, t)}, ' ') AS mtypo, "
        f"array_to_string({mark('words', 'chosen', h, t)}, ' ') AS mclean{kc} FROM lab_typo), "
        f"lab_rows AS (SELECT sentence, CAST(0 AS INTEGER) AS task, sentence AS input, sentence AS output, "
        f"key || ':-1:0' AS example_id{kc} FROM lab_plan WHERE chosen IS NULL "
        f"UNION ALL SELECT sentence, CAST(0 AS INTEGER), typo_s, mtypo, key || ':' || copy || ':0'{kc} FROM lab_mark "
        f"UNION ALL SELECT sentence, CAST(1 AS INTEGER), mtypo, mclean, key || ':' || copy || ':1'{kc} FROM lab_mark)"
    )


def dataset_ctes(src: str, cfg: LabelConfig, text: str = "sentence", keep: tuple = ()) -> str:
    """CTEs ending in ``lab(sentence, input, output, task, num_tokens, *keep)``."""
    kc = "".join(f", {c}" for c in keep)
    prompted = (f"CASE WHEN task = 0 THEN {S.add_prompt(cfg.detect_prompt, 'input')} "
                f"ELSE {S.add_prompt(cfg.correct_prompt, 'input')} END")
    return (
        rows_ctes(src, cfg, text, keep) + ", "
        f"lab_tag AS (SELECT sentence, {prompted} AS input, output, task, example_id{kc} FROM lab_rows), "
        f"lab_all AS (SELECT sentence, input, output, task, {S.count_tokens('input')} AS num_tokens, "
        f"example_id{kc} FROM lab_tag), "
        f"lab AS (SELECT * FROM lab_all WHERE num_tokens <= {cfg.max_length})"
    )
