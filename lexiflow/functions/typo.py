"""Word validity, single-character typos and typo marks as Column expressions.

All randomness comes from ``draw.draw_hash`` (see there): a typo is a pure
function of (seed, row key, copy, word index, attempt).
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .draw import draw_hash, scaled, word32
from .util import let

ASCII_WORD = "^[A-Za-z]+\\z"
ALPHABET = string.ascii_lowercase
# An attempt keeps the word with a probability of at most 0.26 (a word of one
# letter), so that 40 attempts all fail with one below 1e-23.
MAX_TYPO_ATTEMPTS = 40
# kinds, in draw order: 0 insert, 1 remove, 2 replace, 3 swap adjacent
N_KINDS = 4  # ``typo_candidate`` compares digests with the quarters of this


def check_min_chars(min_chars: int) -> None:
    if min_chars < 2:
        raise ValueError(f"a word needs at least 2 letters to swap two of them, not {min_chars}")


def valid_word(w: Column, min_chars: int = 2, stop_words: Sequence[str] | Column | None = None) -> Column:
    """ASCII letters only, at least ``min_chars`` long, not a stop word (case-sensitive).

    ``stop_words`` is a short literal list or an array Column.
    """
    check_min_chars(min_chars)
    cond = (F.length(w) >= min_chars) & w.rlike(ASCII_WORD)
    if stop_words is None:
        return cond
    if isinstance(stop_words, Column):
        return cond & ~F.array_contains(stop_words, w)
    if len(stop_words) == 0:
        return cond
    return cond & ~w.isin(list(stop_words))


def insert_char(w: Column, pos: Column, ch: Column) -> Column:
    """``w[:pos] + ch + w[pos:]`` (pos in 0..len-1, so never appended)."""
    return F.overlay(w, ch, (pos + 1).cast("int"), F.lit(0))


def remove_char(w: Column, pos: Column) -> Column:
    return F.overlay(w, F.lit(""), (pos + 1).cast("int"), F.lit(1))


def replace_char(w: Column, pos: Column, ch: Column) -> Column:
    return F.overlay(w, ch, (pos + 1).cast("int"), F.lit(1))


def swap_adjacent(w: Column, pos: Column) -> Column:
    """Swap characters pos and pos+1 (pos in 0..len-2)."""
    start = (pos + 1).cast("int")
    return F.overlay(w, F.reverse(w.substr(start, F.lit(2))), start, F.lit(2))


def typo_candidate(w: Column, h: Column) -> Column:
    """One typo attempt from one md5 digest ``h``.

    word 0 picks the kind uniformly, word 1 the position, word 2 the letter.
    """
    # scaled(word 0, N_KINDS) is told by the first hex digit, as digests compare like numbers;
    # the kinds differ in what is put where and for how many letters, so one overlay does all
    swap = h >= "c"
    n = F.length(w).cast("long") - F.when(swap, 1).otherwise(0)
    start = (scaled(word32(h, 1), n) + 1).cast("int")
    ch = F.lit(ALPHABET).substr((scaled(word32(h, 2), 26) + 1).cast("int"), F.lit(1))
    put = F.when(swap, F.reverse(w.substr(start, F.lit(2)))).when((h >= "4") & (h < "8"), "").otherwise(ch)
    return F.overlay(w, put, start, F.when(swap, 2).when(h < "4", 0).otherwise(1))


def generate_typo(w: Column, seed: int, key: Column, copy, index, on_exhausted: str = "error") -> Column:
    """First of up to ``MAX_TYPO_ATTEMPTS`` attempts whose result differs from ``w``.

    Attempts are evaluated lazily (an attempt is computed only while no
    earlier one succeeded), so the result follows the draws' distribution given
    that the word changes. When all fail: ``on_exhausted='error'`` raises;
    ``'keep'`` returns the word unchanged.
    """
    check_on_exhausted(on_exhausted)
    attempt = _attempts(w, seed, key, copy, index)
    return F.coalesce(attempt(F.lit(1)), _later_typo(w, attempt, on_exhausted))


def add_typos(df: DataFrame, words: dict[str, Column], seed: int, key: Column, copy: Column,
              indexes: dict[str, Column], on_exhausted: str = "error") -> DataFrame:
    """``df`` with ``generate_typo`` of several words of a row (null: null), one column each.

    The digest and the first attempt of each are columns of their own, so they are compiled;
    only later attempts go through lambdas, which Spark interprets.
    """
    check_on_exhausted(on_exhausted)
    cols = df.columns
    digests = {f"_h_{c}": draw_hash(seed, key, "typo", copy, indexes[c], F.lit(1)) for c in words}
    df = df.withColumns({**{f"_w_{c}": w for c, w in words.items()}, **digests})
    df = df.withColumns({f"_x_{c}": typo_candidate(F.col(f"_w_{c}"), F.col(f"_h_{c}")) for c in words})

    def first_or_later(c):
        w, x = F.col(f"_w_{c}"), F.col(f"_x_{c}")
        later = _later_typo(w, _attempts(w, seed, key, copy, indexes[c]), on_exhausted)
        return F.when(x != w, x).when(w.isNotNull(), later)

    return df.select(*cols, *[first_or_later(c).alias(c) for c in words])


def check_on_exhausted(on_exhausted: str) -> None:
    if on_exhausted not in ("error", "keep"):
        raise ValueError("on_exhausted must be 'error' or 'keep'")


def _attempts(w: Column, seed: int, key: Column, copy, index):
    def attempt(a):
        made = let(draw_hash(seed, key, "typo", copy, index, a), lambda h: typo_candidate(w, h))
        return let(made, lambda x: F.when(x != w, x))

    return attempt


def _later_typo(w: Column, attempt, on_exhausted: str) -> Column:
    """What follows a failed first attempt: the next ones, then ``on_exhausted``."""
    later = F.aggregate(F.sequence(F.lit(2), F.lit(MAX_TYPO_ATTEMPTS)), F.lit(None).cast("string"),
                        lambda acc, a: F.coalesce(acc, attempt(a)))
    if on_exhausted == "keep":
        return F.coalesce(later, w)
    failed = F.concat(F.lit("no draw changes the word "), w)
    return F.coalesce(later, F.raise_error(failed).cast("string"))


def mark_words(words: Column, chosen: Column, head: str, tail: str) -> Column:
    """Words at ``chosen`` (0-based) wrapped as ``head w tail`` (marks are separate words)."""
    return let(chosen, lambda at: F.transform(words, lambda w, i: F.when(
        F.array_contains(at, i), F.concat(F.lit(head + " "), w, F.lit(" " + tail))).otherwise(w)))


def gaps(words: Column, at: Column) -> Column:
    """The text before, between and behind the words at ``at`` (0-based, ascending, at least
    one), blanks included: one more entry than ``at``."""
    def before(p, j):
        start = F.when(j > 0, F.get(at, j - 1) + 1).otherwise(0)
        left = F.when(j > 0, " ").otherwise("")
        return F.when(p > start, F.concat(left, F.array_join(F.slice(words, start + 1, p - start), " "), F.lit(" "))).otherwise(left)

    last = F.element_at(at, -1) + 1
    rest = F.size(words) - last
    behind = F.when(rest > 0, F.concat(F.lit(" "), F.array_join(F.slice(words, last + 1, F.greatest(rest, F.lit(0))), " "))).otherwise("")
    return F.concat(F.transform(at, before), F.array(behind))


def fill_gaps(between: Column, words: Column, head: str = "", tail: str = "") -> Column:
    """The text whose ``gaps`` are ``between``, with ``words`` in them, each between ``head`` and ``tail``."""
    def put(gap, w):
        return F.when(w.isNull(), gap).otherwise(F.concat(gap, F.lit(head), w, F.lit(tail)))

    return F.array_join(F.zip_with(between, words, put), "")
