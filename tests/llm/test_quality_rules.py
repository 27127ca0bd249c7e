import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {p + j for at in seen.values() if len(at) > 1 for p in at for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(lines), sum("A" <= c <= "Z" for c in text))


TEXTS = [None, "", "  \n ", "a", "a b c", "a b c a b c", "x x x x x", "a\nb\na\n\n \n a", "é #1 $%& <A> |*| \x0b\x0cZ z",
         "A b. A b. A b.\nA b.", "word " * 300, " lead\ttab\r\nline ", "\u00a0 \u2003 x"]


def test_features_equal_plain_python(spark, stored):
    rnd = random.Random(3)
    texts = TEXTS + [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    df = stored(list(enumerate(texts)), "doc_id int, text string")
    for r in Q.with_features(df).collect():
        assert tuple(r["_f"]) == plain(texts[r.doc_id]), texts[r.doc_id]


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("n,k,p", [(10, 0, .3), (500, 1, .02), (2000, 3, .004), (3000, 2, .01), (5000, 90, .02), (9000, 20, .004)])
def test_tail_is_exact(spark, n, k, p):
    got = spark.range(1).select(Q.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    assert math.isclose(got, tail(k, n, p), rel_tol=1e-9)


def test_long_tail_is_bounded_from_above(spark, monkeypatch):
    exact = tail(60, 5000, .02)
    monkeypatch.setattr(Q, "TAIL", 5)
    got = spark.range(1).select(Q.binomial_tail(F.lit(60).cast("long"), F.lit(5000).cast("long"), .02)).first()[0]
    assert exact <= got < 3 * exact


def test_strata_without_evidence_reject_nothing(spark, stored):
    good = "plain words of a good text " * 12
    junk = "#### $$$$ " * 40 + good
    rows = [(i, f"{good} {i}", "en") for i in range(3000)] + [(5000 + i, junk + str(i), "en") for i in range(50)]
    rows += [(9000, junk, "xx"), (9001, junk, None), (9002, None, "en")]
    rows = [(d, " ".join(w + str(j) for j, w in enumerate((t or "").split())) if t else t, s) for d, t, s in rows]
    docs = stored(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as stratum", "1 as f")
    labels = stored([(i, 1) for i in range(3000)] + [(5000 + i, 0) for i in range(40)] + [(None, 1), (7, None), (2, 1), (2, 1)],
                    "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.judge_documents(docs, labels).collect()}
    assert all(got[i].kept for i in range(3000))
    assert not any(got[5000 + i].kept for i in range(50))
    assert "symbols" in got[5000].failed_rules
    assert got[9000].kept and got[9001].kept  # no good documents there to learn a cutoff from
    assert got[9002].base_failed and not got[9002].kept
    kept = {r.doc_id for r in Q.keep_documents(docs, labels).collect()}
    assert kept == {d for d, r in got.items() if r.kept}
    assert Q.keep_documents(docs, labels).columns == docs.columns


def test_conflicting_labels_and_empty_tables(spark, stored):
    labels = stored([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    assert [r.id for r in Q.good_documents(labels).collect()] == [2]
    none = stored([], "doc_id long, text string, lang string", 1)
    assert Q.judge_documents(none, labels).count() == 0
    one = stored([(1, "#" * 9 + " a" * 60, "en")], "doc_id long, text string, lang string", 1)
    got = Q.judge_documents(one, stored([], "doc_id long, quality int", 1)).first()
    assert got.failed_rules == [] and got.base_failed  # one word again and again


def test_native(spark, stored):
    docs = stored([(1, "a b", "en")], "doc_id long, text string, lang string", 1)
    plan = Q.judge_documents(docs, stored([(1, 1)], "doc_id long, quality int", 1))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
