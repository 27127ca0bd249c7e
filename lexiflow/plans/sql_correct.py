"""DuckDB SQL twins of edit distance, marking/locating and the corrector."""

from __future__ import annotations

from ..operators.correct import CorrectConfig
from . import sql_label as SL
from . import sql_text as S


def edit_distance(a: str, b: str) -> str:
    inner = (f"list_reduce(range(1, length({b}) + 1), lambda eda, edj: list_append(eda, least("
             f"edp[edj + 1] + 1, eda[edj] + 1, edp[edj] + CASE WHEN substr({a}, edi, 1) = substr({b}, edj, 1) "
             f"THEN 0 ELSE 2 END)), [edi])")
    dp = (f"list_reduce(range(1, length({a}) + 1), lambda edp, edi: {inner}, "
          f"range(0, length({b}) + 1))[length({b}) + 1]")
    return (f"CAST(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN length({a}) = 0 THEN length({b}) "
            f"WHEN length({b}) = 0 THEN length({a}) ELSE {dp} END AS INTEGER)")


def within(a: str, b: str, max_d: int | None) -> str:
    return "TRUE" if max_d is None else f"({edit_distance(a, b)} <= {max_d})"


def is_mark(w: str, h: str, t: str) -> str:
    return f"({w} = {S.lit(h)} OR {w} = {S.lit(t)})"


def locate_position(mw: str, h: str, t: str, n_prompt: int) -> str:
    return (f"list_transform(list_filter(range(len({mw})), lambda lp: {mw}[lp + 1] = {S.lit(h)}), "
            f"lambda lp: CAST(lp - len(list_filter({mw}[1:lp], lambda lz: {is_mark('lz', h, t)})) + {n_prompt} "
            f"AS INTEGER))")


def locate_pair(dw: str, mw: str, h: str, t: str, n_prompt: int) -> str:
    left = (f"coalesce(list_filter({mw}[1:lp], lambda lz: NOT {is_mark('lz', h, t)})[-1], {dw}[{n_prompt}])")
    pairs = (f"list_filter(list_transform(list_filter(range(len({mw})), lambda lp: {mw}[lp + 1] = {S.lit(h)}), "
             f"lambda lp: {{'l': {left}, 'r': {mw}[lp + 2]}}), lambda ls: ls.r IS NOT NULL)")
    return (f"list_transform(list_filter(range(1, len({dw})), lambda lj: len(list_filter({pairs}, "
            f"lambda lq: lq.l = {dw}[lj] AND lq.r = {dw}[lj + 1])) > 0), lambda lj: CAST(lj AS INTEGER))")


def apply_corrections(words: str, idx: str, corr: str, max_d: int | None) -> str:
    n = f"least(len({idx}), len({corr}))"
    step = (f"list_transform(apa, lambda apw, apj: CASE WHEN apj - 1 = {idx}[apk + 1] AND "
            f"{within('apw', f'{corr}[apk + 1]', max_d)} THEN {corr}[apk + 1] ELSE apw END)")
    return f"(CASE WHEN {n} > 0 THEN list_reduce(range({n}), lambda apa, apk: {step}, {words}) ELSE {words} END)"


def delete_variants(w: str, d: int) -> str:
    level = f"[{w}]"
    parts = [level]
    for _ in range(d):
        level = (f"list_distinct(flatten(list_transform({level}, lambda dv: list_transform("
                 f"range(1, length(dv) + 1), lambda dj: substr(dv, 1, dj - 1) || substr(dv, dj + 1)))))")
        parts.append(level)
    return "list_distinct(" + " || ".join(parts) + ")"


def corrector_ctes(words_src: str, cfg: CorrectConfig) -> str:
    """After ``voc``: from ``words_src(id, pos, word)`` build ``flags(id, flags)``.

    ``flags`` = list of {pos, best} for unknown valid words, sorted by pos.
    """
    d = cfg.max_edit_distance
    valid = SL.valid_word("word", cfg.min_num_characters)
    return (
        f"known AS (SELECT word, freq FROM voc WHERE freq >= {cfg.min_freq}), "
        f"occ AS (SELECT * FROM {words_src} WHERE {valid}), "
        "unk AS (SELECT DISTINCT word FROM occ WHERE word NOT IN (SELECT word FROM known)), "
        f"tgt AS (SELECT word, freq FROM known WHERE {valid}), "
        f"lv AS (SELECT l, v, length(l) - length(v) AS dl FROM (SELECT word AS l, "
        f"unnest({delete_variants('word', d)}) AS v FROM unk)), "
        f"lv2 AS (SELECT l, v, dl, unnest(range(0, {d} - dl + 1)) AS dr FROM lv), "
        f"rv AS (SELECT r, v, length(r) - length(v) AS dr FROM (SELECT word AS r, "
        f"unnest({delete_variants('word', d)}) AS v FROM tgt)), "
        "fz AS (SELECT l AS word, r AS cand, CAST(min(dl + rv.dr) AS INTEGER) AS distance "
        "FROM lv2 JOIN rv USING (v, dr) GROUP BY l, r), "
        "best AS (SELECT word, cand AS best, distance FROM (SELECT fz.*, row_number() OVER (PARTITION BY fz.word "
        "ORDER BY distance, t.freq DESC, cand) AS rn FROM fz JOIN tgt t ON t.word = fz.cand) WHERE rn = 1), "
        "fixes AS (SELECT unk.word, best.best FROM unk LEFT JOIN best USING (word)), "
        "flags AS (SELECT id, list({'pos': pos, 'best': best} ORDER BY pos) AS flags "
        "FROM occ JOIN fixes USING (word) GROUP BY id)"
    )


def chain_select(cfg: CorrectConfig, text: str = "clean", flags: str = "fl") -> str:
    """Select-list expressions of the M2 chain over ``text`` and ``flags``."""
    h, t = cfg.head_mark, cfg.tail_mark
    n = len(cfg.detect_prompt.split(" "))
    words = f"string_split({text}, ' ')"
    upos = f"list_transform({flags}, lambda fs: fs.pos)"
    detected = f"array_to_string({SL.mark(words, upos, h, t)}, ' ')"
    return detected, n


def chain_ctes(src: str, cfg: CorrectConfig) -> str:
    """``src(id, clean, fl)`` -> ``chained(id, corrected)``: the best words at their known
    positions, or with ``locate_mode="pair"`` the marked texts made and parsed."""
    if cfg.locate_mode == "position":
        best = "list_transform(list_filter(fl, lambda fb: fb.pos = li - 1), lambda fb: fb.best)[1]"
        return (f"chained AS (SELECT id, array_to_string(list_transform(string_split(clean, ' '), "
                f"lambda lw, li: coalesce({best}, lw)), ' ') AS corrected FROM {src})")
    h, t = cfg.head_mark, cfg.tail_mark
    detected, n = chain_select(cfg)
    dw = f"string_split({S.add_prompt(cfg.detect_prompt, 'clean')}, ' ')"
    shifted = "list_transform(fl, lambda fs, fk: {'pos': fs.pos + 2 * (fk - 1) + 1, 'best': fs.best})"
    best_at = "list_transform(list_filter(sh, lambda fb: fb.pos = li - 1), lambda fb: fb.best)[1]"
    corr_marked = (f"array_to_string(list_transform(mw, lambda lw, li: CASE WHEN li - 1 > 0 AND li - 1 < len(mw) - 1 "
                   f"AND mw[li - 1] = {S.lit(h)} AND mw[li + 1] = {S.lit(t)} THEN coalesce({best_at}, lw) "
                   f"ELSE lw END), ' ')")
    idx = locate_pair("dw", "mw", h, t, n)
    return (
        f"ch1 AS (SELECT id, {dw} AS dw, string_split({detected}, ' ') AS mw, {shifted} AS sh FROM {src}), "
        f"ch2 AS (SELECT id, dw, {idx} AS idx, {S.extract_marked(corr_marked, h, t)} AS corr FROM ch1), "
        f"chained AS (SELECT id, array_to_string("
        f"{apply_corrections('dw', 'idx', 'corr', cfg.max_edit_distance)}[{n + 1}:], ' ') AS corrected FROM ch2)"
    )
