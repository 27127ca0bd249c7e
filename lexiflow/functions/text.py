"""Text scalar functions as Spark Column expressions.

Regular expressions avoid the engine-dependent classes ``\\s``/``\\w`` and
spell out their character classes, so a pattern means the same in Java regex
and in RE2 (the SQL twins). The one Java-only pattern (the period rule, which
uses look-around for speed) has an RE2 twin with the same effect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Whitespace as Python's str.isspace()/str.strip()/re's \s see it: Unicode
# category Z plus \t-\r, \x1c-\x1f and \x85 (the identity is checked against
# Python's own tables in the tests). A category test is one lookup per
# character in Java; a long list of ranges is several.
SPACE_CLASS = "[\\p{Z}\\t-\\r\\x{1c}-\\x{1f}\\x{85}]"
SPACE_RUN = SPACE_CLASS + "+"
# A run that is not one blank already, for replacing runs by one blank.
LONG_SPACE = " " + SPACE_RUN + "|[" + SPACE_CLASS + "&&[^ ]]" + SPACE_CLASS + "*"
STRIP_PATTERN = "^" + SPACE_RUN + "|" + SPACE_RUN + "\\z"

# Python's \w for str patterns: letters, numbers and underscore.
WORD_CLASS = "[\\p{L}\\p{N}_]"

# Punctuation that the typesetting cleaner surrounds with blanks.
PAD_PUNCTUATION = ",;:()?!"

# Header that starts the section kept by ``extract_section``.
DEFAULT_SECTION_HEADER = "finding" + WORD_CLASS + "* :"

SENTENCE_END = " ."


def java_flags(case_insensitive: bool, dotall: bool = False) -> str:
    """Inline flags for Java regex; ``u`` makes case folding Unicode-aware."""
    f = ("s" if dotall else "") + ("iu" if case_insensitive else "")
    return f"(?{f})" if f else ""


def newline_to_space(c: Column) -> Column:
    """Every ``\\n`` becomes one blank; nothing else changes."""
    return F.replace(c, F.lit("\n"), F.lit(" "))


def strip_space(c: Column) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace."""
    t = F.trim(c)
    ends = F.concat(F.substring(t, 1, 1), F.substring(t, -1, 1))
    return F.when(ends.rlike(SPACE_CLASS), F.regexp_replace(t, STRIP_PATTERN, "")).otherwise(t)


def typeset_clean(c: Column) -> Column:
    """Our typesetting normalisation.

    1. newlines become blanks;
    2. each of ``,;:()?!`` is surrounded by blanks;
    3. a period after a non-digit, non-space character and before whitespace
       or the end becomes `` .`` (so ``2.`` enumerators stay whole);
    4. whitespace runs collapse to one blank; outer blanks are removed.
    """
    t = newline_to_space(c)
    t = F.regexp_replace(t, "([" + _escape_class(PAD_PUNCTUATION) + "])", " $1 ")
    t = F.regexp_replace(t, _PERIOD_PATTERN_JAVA, " .")
    return F.trim(F.regexp_replace(t, LONG_SPACE, " "))


# The period rule, consuming its neighbours (RE2 has no look-around; used by
# the SQL twin) ...
_PERIOD_PATTERN = (
    "([^0-9" + SPACE_CLASS[1:-1] + "])\\.(" + SPACE_CLASS + "|\\z)"
)
# ... and the same rule for Java, anchored on the literal period so the
# classes are tested only at periods. Equivalent: a consumed neighbour can
# never be a period that the rule would rewrite itself.
_PERIOD_PATTERN_JAVA = (
    "\\.(?<=[^0-9" + SPACE_CLASS[1:-1] + "]\\.)(?=" + SPACE_CLASS + "|\\z)"
)


def _escape_class(chars: str) -> str:
    return "".join("\\" + ch if ch in "\\]^-[" else ch for ch in chars)


def extract_section(c: Column, header: str = DEFAULT_SECTION_HEADER,
                    case_insensitive: bool = True) -> Column:
    """Text from the start of the first ``header`` match to the end.

    No match leaves the text unchanged. The header is part of the result.
    """
    flags = java_flags(case_insensitive)
    found = c.rlike(flags + header)
    section = F.regexp_extract(c, java_flags(case_insensitive, dotall=True)
                               + "(" + header + ".*)", 1)
    return F.when(found, section).otherwise(c)


def segment_sentence(c: Column) -> Column:
    """Split on literal `` .``; drop empty pieces, strip, re-append `` .``."""
    pieces = F.split(c, " \\.", -1)
    return F.transform(
        F.filter(pieces, lambda p: F.length(p) > 0),
        lambda p: F.concat(strip_space(p), F.lit(SENTENCE_END)),
    )


def content_key(c: Column) -> Column:
    """Text with all whitespace removed (key for de-duplication)."""
    return F.regexp_replace(F.replace(c, F.lit(" "), F.lit("")), SPACE_RUN, "")


def split_words(c: Column) -> Column:
    """Split on single blanks, keeping empty words (``str.split(' ')``)."""
    return F.split(c, " ", -1)


def join_words(a: Column) -> Column:
    return F.array_join(a, " ")


def add_prompt(prompt: str, c: Column) -> Column:
    """``prompt + ' ' + text``."""
    return F.concat(F.lit(prompt + " "), c)


def strip_prompt_words(c: Column, prompt: str) -> Column:
    """Drop as many leading words as the prompt has blank-separated words."""
    n = len(prompt.split(" "))
    words = split_words(c)
    return join_words(F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0))))


def count_tokens(c: Column) -> Column:
    """Built-in token counter: non-empty blank-separated words plus an end token."""
    return (F.size(F.array_remove(split_words(c), "")) + 1).cast("int")


def quote_regex(s: str) -> str:
    """Escape every regex metacharacter of a literal (works in Java and RE2)."""
    return "".join("\\" + ch if ch in r"\^$.|?*+()[]{}/-" else ch for ch in s)


def extract_marked(c: Column, head: str, tail: str) -> Column:
    """All shortest spans ``head <blank> x <blank> tail``, left to right.

    The whole mark is quoted (the original quoted only its first character).
    """
    return F.regexp_extract_all(c, F.lit(marked_pattern(head, tail)), 1)


def marked_pattern(head: str, tail: str) -> str:
    # ``[^\\n]`` is Python's ``.``: Java's ``.`` would also stop at \\r and
    # other line separators.
    return quote_regex(head) + SPACE_CLASS + "([^\\n]+?)" + SPACE_CLASS + quote_regex(tail)
