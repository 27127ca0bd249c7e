"""Text functions against direct Python statements of the original rules."""

import re

from pyspark.sql import functions as F

from lexiflow.functions import text as T

TRICKY = [
    "a .b .", " . x", "abc", "", " .  . ", "x .5 y", "no end", "a .", " .",
    "tab\there . nbsp .", "　ideo . space", "multi  . blank",
]


def _col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def py_segment(text):
    return [p.strip() + " ." for p in text.split(" .") if len(p) > 0]


def test_segment_matches_python(spark):
    got = _col(spark, TRICKY, T.segment_sentence)
    assert got == [py_segment(t) for t in TRICKY]


def test_strip_matches_python(spark):
    vals = ["  a  ", " x ", "\x1cy\x1f", "　", "in side", "\t\n z \r"]
    assert _col(spark, vals, T.strip_space) == [v.strip() for v in vals]


def test_content_key_matches_python(spark):
    vals = ["a b\tc", "x y　z", "p\x1cq\x85r", "  "]
    assert _col(spark, vals, T.content_key) == [re.sub(r"\s+", "", v) for v in vals]


def test_extract_section_examples(spark):
    cases = {
        "intro FINDINGS : rest": "FINDINGS : rest",
        "x findingsé : y": "findingsé : y",
        "none here": "none here",
        "a\nFinding :b\nc finding : d": "Finding :b\nc finding : d",  # the first header counts
        "finding: no blank": "finding: no blank",
    }
    assert _col(spark, list(cases), T.extract_section) == list(cases.values())


def test_typeset_clean_examples(spark):
    vals = ["Rain at noon.\nNo wind:calm.", "7. Low tide again.", "# Harbour (east)!"]
    assert _col(spark, vals, T.typeset_clean) == [
        "Rain at noon . No wind : calm .",
        "7. Low tide again .",
        "# Harbour ( east ) !",
    ]


def test_extract_marked_matches_python(spark):
    vals = ["$ ab @ x $ cd ef @", "$ a@", "no marks", "$  b  @"]
    got = _col(spark, vals, lambda c: T.extract_marked(c, "$", "@"))
    assert got == [re.findall(r"\$\s(.+?)\s@", v) for v in vals]


def test_split_join_round_trip(spark):
    vals = ["a  b", " lead", "trail ", "one"]
    assert _col(spark, vals, T.split_words) == [v.split(" ") for v in vals]
    assert _col(spark, vals, lambda c: T.join_words(T.split_words(c))) == vals


def test_strip_prompt_and_count_tokens(spark):
    vals = ["detect typo: a b", "detect typo:", "x  y"]
    assert _col(spark, vals, lambda c: T.strip_prompt_words(c, "detect typo:")) == [
        " ".join(v.split(" ")[2:]) for v in vals]
    assert _col(spark, vals, T.count_tokens) == [len([w for w in v.split(" ") if w]) + 1 for v in vals]


def test_space_class_is_python_whitespace(spark):
    """The category-based class equals str.isspace() over all code points."""
    import sys
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    near = ["​", "᠎", "﻿", "a", "_", "\x1b", "\x20"]
    df = spark.createDataFrame([(ch,) for ch in spaces + near], "c string")
    got = {r[0]: r[1] for r in df.select("c", F.col("c").rlike("^" + T.SPACE_CLASS + "$")).collect()}
    assert all(got[ch] == ch.isspace() for ch in spaces + near)


def test_period_rule_java_equals_re2_form(spark):
    vals = ["a.. b", "x. y.", "2. z.", "end.", "a. b", "..", "a.　.", "3.5 x.5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    java = [r[0] for r in df.select(F.regexp_replace("s", T._PERIOD_PATTERN_JAVA, " .")).collect()]
    re2 = [r[0] for r in df.select(F.regexp_replace("s", T._PERIOD_PATTERN, "$1 .$2")).collect()]
    assert java == re2
