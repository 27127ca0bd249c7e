import random

import numpy as np
import pytest

from lexiflow.llm import langid as G

STEMS = {"aa": ["banu", "kilo", "mera", "tovu"], "bb": ["schraft", "wirgen", "zeuch", "pfahl"], "cc": ["naçaõ", "lhéra", "quião"]}


def text(lang, n, seed):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(STEMS[lang]) for _ in range(n))


def plain_scores(texts, langs, table):
    out = []
    for t in texts:
        p = b" " + t.lower().translate(G.LETTERS) + b" "
        got = [int(np.uint32((p[i] << 16 | p[i + 1] << 8 | p[i + 2]) * 2654435761 & 0xFFFFFFFF) >> 17)
               for i in range(len(p) - 2) if p[i:i + 3] != b"   "]
        out.append((len(got), table[got].sum(axis=0)))
    return out


def test_chunks_lose_nothing(monkeypatch):
    texts = [b"", b"a", b"Hello, w\xc3\xb6rld! 123", b"xyz " * 50, b"..."]
    whole = [[] for _ in texts]
    for b, w in G.trigram_chunks(texts):
        for x, i in zip(b.tolist(), w.tolist()):
            whole[i].append(x)
    monkeypatch.setattr(G, "CHUNK", 7)
    cut = [[] for _ in texts]
    for b, w in G.trigram_chunks(texts):
        for x, i in zip(b.tolist(), w.tolist()):
            cut[i].append(x)
    assert cut == whole
    assert [len(x) for x in whole][:2] == [0, 1]


@pytest.fixture
def labelled(stored):
    return stored([(text(x, 30, i), x) for i in range(12) for x in STEMS] + [(None, "aa"), ("", None)], "text string, lang string")


def test_scores_equal_plain_python(spark, stored, labelled):
    ((langs, table),) = G.trigram_blocks(G.learn(labelled, "text", "lang"), G.FusionConfig())
    assert langs == sorted(STEMS)
    texts = ["banu kilo", None, "", "12 .", text("cc", 500, 1)]
    df = stored(list(enumerate(texts)), "k int, text string")
    got = {r.k: r["_text"] for r in G.text_scores(df, "text", langs, table).collect()}
    for i, (n, ll) in enumerate(plain_scores([(t or "").encode() for t in texts], langs, table)):
        assert got[i].n == n and np.allclose(got[i].ll, ll)


def page(lang, body):
    return f"<html><head><script>var x='schraft';</script></head><body lang='zz'>{body}</body></html>".replace(
        "<html>", f'<html lang="{lang}">' if lang else "<html>")


def test_held_out_pages_and_priors(spark, stored, labelled):
    rows = []
    for i in range(60):
        x = list(STEMS)[i % 3]
        rows.append((i, f"https://h{i % 3}.example.org/{i}", page(x if i % 2 else None, text(x, 25, 100 + i))))
    rows += [(100, None, None), (101, "nourl", ""), (102, "http://h0.example.org/", "<p>123</p>"), (103, "http://new.example.org/", page("bb", "12")),
             (1, "https://h1.example.org/1", rows[1][2])]
    df = stored(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as declared")
    got = {r.page_id: r for r in G.identify_pages(df, labelled).collect()}
    assert all(got[i].lang == list(STEMS)[i % 3] and got[i].accepted for i in range(60))
    assert not any(got[i].accepted for i in (100, 101, 102, 103))
    assert got[102].lang == "aa"  # no text: the host's prior decides
    assert got[103].lang == "bb"  # no text, new host: the declared language decides
    assert got[1].declared == "bb" and got[0].declared is None


def test_votes_leave_the_row_out(spark, stored):
    """A single row on its host gets no support from its own vote."""
    ev = [(None, "h", "h", None, 5, [0.0, -0.1]), (None, "g", "g", None, 5, [-9.0, 0.0])]
    df = stored(ev, "declared string, host string, domain string, suffix string, n long, ll array<double>", 1)
    cfg = G.FusionConfig(temper=1.0)
    got = {r.host: r for r in G.fuse(df, df, ["a", "b"], cfg).collect()}
    # without its own vote: counts everywhere (0, 1), so a has 1/3 and b 2/3
    assert got["h"].lang == "b" and abs(got["h"].posterior - 2 / 3 * np.exp(-.1) / (1 / 3 + 2 / 3 * np.exp(-.1))) < 1e-9


def test_no_labels_and_empty(spark, stored, labelled):
    none = stored([], "text string, lang string", 1)
    pages = stored([(1, "http://a.b/", "<p>banu</p>")], "page_id long, url string, html string", 1)
    r = G.identify_pages(pages, none).first()
    assert r.lang is None and not r.accepted
    assert G.identify_pages(stored([], "page_id long, url string, html string", 1), labelled).count() == 0


def test_blocks_of_languages_change_nothing(spark, stored, labelled, monkeypatch):
    counts = G.learn(labelled, "text", "lang")
    df = stored([(i, text(x, 9, i)) for i, x in enumerate(STEMS)] + [(9, None)], "k int, text string")
    cfg = G.FusionConfig()
    whole, langs = G.all_scores(df, "text", counts, cfg)
    want = {r.k: r["_text"] for r in whole.collect()}
    monkeypatch.setattr(G, "BLOCK_LANGUAGES", 2)
    assert sorted(map(tuple, G.learn(labelled, "text", "lang").collect())) == sorted(map(tuple, counts.collect()))
    cut, same = G.all_scores(df, "text", counts, cfg)
    assert langs == same == sorted(STEMS)
    got = {r.k: r["_text"] for r in cut.collect()}
    assert all(got[k].n == want[k].n and np.allclose(got[k].ll, want[k].ll) for k in want)


def test_tags_are_primary_subtags_and_any_number_of_languages_works(spark, stored):
    tags = ["EN", "en-US", "en", " en_GB", "", "-", "e1", "averylongtag", None]
    rows = [(i, "some words", t) for i, t in enumerate(tags)]
    names = [f"{a}{b}" for a in "abcdefghijklm" for b in "abcdefghijklm"]
    rows += [(100 + i, f"{x}{x}k {x}vu {x}{x}k", x) for i, x in enumerate(names)]
    df = stored(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' as source")
    got = {r["row"].doc_id: r for r in G.identify_documents(df).collect()}
    assert len(got) == len(rows) and len(names) > G.BLOCK_LANGUAGES
    assert all(got[i].text_lang == "en" for i in range(len(tags)))
    assert sum(got[100 + i].text_lang == x for i, x in enumerate(names)) > 0.95 * len(names)


def test_texts_of_no_known_language_are_not_accepted(spark, stored):
    rnd = random.Random(3)
    rows = [(i, text(x, 60, i), x) for i in range(40) for x in STEMS]
    rows += [(100 + i, " ".join("".join(rnd.choices("qxzkwvj", k=6)) for _ in range(40)), "aa") for i in range(3)]
    rows += [(200, "これはにほんごのぶんしょうです " * 20, "bb"), (201, text("aa", 40, 7) + " qxzkwvj", "aa")]
    df = stored(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' as source")
    learnt = df.where("doc_id < 100")
    counts = G.learn(learnt, "text", "lang")
    scored, langs = G.all_scores(df.withColumnRenamed("lang", "declared").withColumn("host", G.F.lit("s")), "text", counts, G.FusionConfig())
    ev = scored.selectExpr("doc_id", "declared", "host", "host as domain", "cast(null as string) as suffix", "_text.n", "_text.ll")
    ok = {r.doc_id: r.accepted for r in G.fuse(ev, ev, langs, G.FusionConfig()).collect()}
    assert [k for k, v in ok.items() if not v] and sorted({k for k, v in ok.items() if not v}) == [100, 101, 102, 200]


def test_documents_keep_their_columns(spark, stored):
    rows = [(i, text(x, 30, i), x, "s", 1) for i in range(10) for x in STEMS] + [(99, None, None, None, None), (98, "", "aa", "s", 0), (1, "..", "bb", "s", 2)]
    df = stored(rows, "doc_id long, text string, lang string, source string, vote long").selectExpr("*", "1 as n", "'r' as ll", "2 as declared")
    got = G.identify_documents(df)
    kept = got.where("accepted").select("row.*")
    assert kept.columns == df.columns and kept.count() == 30
    assert got.where("accepted and lang <> row.lang").count() == 0


def test_a_filter_on_the_result_does_not_score_texts_again(stored):
    docs = stored([(i, ["the house is here", "das haus ist hier"][i % 2], ["en", "de"][i % 2], "a.org") for i in range(20)],
                  "doc_id long, text string, lang string, source string")
    kept = G.identify_documents(docs).where("accepted").select("row.*")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1
    assert sorted(kept.collect()) == sorted(docs.collect())
