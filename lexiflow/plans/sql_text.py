"""DuckDB SQL twins of the Column functions, used by the oracle queries.

Each helper takes a SQL expression string and returns one. Patterns are the
very strings the Spark side uses, with ``$n`` back-references spelled ``\\n``.
"""

from __future__ import annotations

from ..functions import text as T


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def newline_to_space(e: str) -> str:
    return f"regexp_replace({e}, chr(10), ' ', 'g')"


def strip_space(e: str) -> str:
    return f"regexp_replace({e}, {lit(T.STRIP_PATTERN)}, '', 'g')"


def typeset_clean(e: str) -> str:
    t = newline_to_space(e)
    t = f"regexp_replace({t}, {lit('([' + T._escape_class(T.PAD_PUNCTUATION) + '])')}, ' \\1 ', 'g')"
    t = f"regexp_replace({t}, {lit(T._PERIOD_PATTERN)}, '\\1 .\\2', 'g')"
    t = f"regexp_replace({t}, {lit(T.SPACE_RUN)}, ' ', 'g')"
    return f"regexp_replace({t}, '^ | \\z', '', 'g')"


def re2_flags(case_insensitive: bool, dotall: bool = False) -> str:
    f = ("s" if dotall else "") + ("i" if case_insensitive else "")
    return f"(?{f})" if f else ""


def extract_section(e: str, header: str = T.DEFAULT_SECTION_HEADER,
                    case_insensitive: bool = True) -> str:
    found = f"regexp_matches({e}, {lit(re2_flags(case_insensitive) + header)})"
    sect = f"regexp_extract({e}, {lit(re2_flags(case_insensitive, True) + '(' + header + '.*)')}, 1)"
    return f"(CASE WHEN {found} THEN {sect} ELSE {e} END)"


def segment_sentence(e: str) -> str:
    return (f"list_transform(list_filter(string_split({e}, ' .'), lambda p: length(p) > 0), "
            f"lambda p: {strip_space('p')} || ' .')")


def content_key(e: str) -> str:
    return f"regexp_replace({e}, {lit(T.SPACE_RUN)}, '', 'g')"


def split_words(e: str) -> str:
    return f"string_split({e}, ' ')"


def count_tokens(e: str) -> str:
    return f"CAST(len(list_filter(string_split({e}, ' '), lambda w: w <> '')) + 1 AS INTEGER)"


def add_prompt(prompt: str, e: str) -> str:
    return f"({lit(prompt + ' ')} || {e})"


def strip_prompt_words(e: str, prompt: str) -> str:
    n = len(prompt.split(" "))
    return f"array_to_string(string_split({e}, ' ')[{n + 1}:], ' ')"


def extract_marked(e: str, head: str, tail: str) -> str:
    return f"regexp_extract_all({e}, {lit(T.marked_pattern(head, tail))}, 1)"


def md5_word(h: str, k: int = 0) -> str:
    """k-th 32-bit word of an md5 hex string, as BIGINT."""
    return f"CAST(('0x' || substr({h}, {8 * k + 1}, 8)) AS BIGINT)"


def draw_hash(seed: int, key: str, tag: str, *parts: str) -> str:
    items = [lit(str(seed)), key, lit(tag)] + [f"CAST({p} AS VARCHAR)" for p in parts]
    return f"md5(concat_ws('|', {', '.join(items)}))"


def scaled(u: str, n: str) -> str:
    return f"(({u}) * ({n})) >> 32"
