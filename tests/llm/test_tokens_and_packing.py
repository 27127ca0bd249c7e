import collections
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexiflow.llm import packing as K
from lexiflow.llm import token_count as C

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)
MERGER = C.RankMerger(PATH)
ODD = ["", None, " \n\t ", "a<|endoftext|>b <|startoftext|>", "İstanbul ΣΑΣ é ﬁ １２ don't we'll 's", "aaaa" * 300,
       "x y z​q\x1c\x85k", "中文字符 测试😀😀👩‍👩‍👧", "ß̇ '''s'd", "abc" * 5000, "word " * 3000]


def ids(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark, stored):
    df = stored([(i, t) for i, t in enumerate(ODD)] + [(3, "twice"), (3, "twice"), (None, "no id")],
                "doc_id long, text string").selectExpr("*", "'x' as id", "1 as n_tokens")
    got = collections.Counter(tuple(r) for r in C.token_counts(df, PATH, limit=5).collect())
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = collections.Counter((d, len((t or "").encode()), len(ids(t)), len(ids(t)) > 5) for d, t in rows)
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=8))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    b = [t.encode() for t in texts]
    assert C.text_counts(b, MERGER, {}) == [len(ids(t)) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in K.encode_texts(b, PATH)] == [ids(t) for t in texts]


@pytest.mark.parametrize("letters", ["a", "ab", "etaoinshrdlu", "abcdefghijklmnopqrstuvwxyz", "的一是不了人"])
def test_long_words_by_queues_equal_the_library(letters, monkeypatch):
    rnd = random.Random(4)
    words = ["".join(rnd.choices(letters, k=n)) for n in (1, 255, 256, 257, 300, 5000)] + ["the" * 300]
    want = [len(ids(w)) for w in words]
    assert MERGER.count_words(words) == want
    monkeypatch.setattr(C, "LONG_PIECE", 0)  # short ones too
    assert MERGER.count_words(words) == want


LATIN = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100))]  # with the signs × and ÷
MARKS = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]


def test_latin_words_equal_the_library(monkeypatch):
    """Letters with every mark behind them, before them and between them, and what looks like such words."""
    rnd = random.Random(6)
    words = LATIN + ["a" + c for c in LATIN] + [w + m for w in ("the", "Übel", "école") for m in MARKS]
    words += ["".join(rnd.choices(LATIN, k=rnd.randint(1, 12))) + "".join(rnd.choices(MARKS, k=rnd.randint(0, 4))) for _ in range(2000)]
    words += [m + "it" + n + "s" for m in ["", *MARKS] for n in MARKS] + ["e\u0301te\u0301", "a\u0300.", "ªº", "µm", "İi", "x1", "'s", "s'", "<|endoftext|>.", "A<|b"]
    for size in (1, 100, len(words)):
        monkeypatch.setattr(K, "_loaded", {})
        for i in range(0, len(words), size):
            part = words[i:i + size]
            got = K.encode_texts([w.encode() for w in part] + [" ".join(part).encode()], PATH)
            assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids(w) for w in part] + [ids(" ".join(part))]
            if i > 300:
                break


def test_plain_words_skip_normalizer_and_pre_tokenizer(monkeypatch):
    """Most of the time of a new word went there."""
    whole = []
    learn = K.WordModel.learn_whole
    monkeypatch.setattr(K, "_loaded", {})
    monkeypatch.setattr(K.WordModel, "learn_whole", lambda self, words, table: (whole.extend(words), learn(self, words, table)))
    text = " ".join(f"{a}{b}ñé{c}" for a in "abcdefgh" for b in ("on", "Über", "st") for c in ("", ",", ".&&&", "%%%"))
    assert np.frombuffer(K.encode_texts([text.encode()], PATH)[0], "<u4").tolist() == ids(text)
    assert sorted(whole) == [b"%%%", b",", b".&&&"]


def test_a_tokenizer_of_other_rules_goes_the_whole_way(tmp_path):
    """Without the lower-casing, letters are not made small."""
    spec = json.loads(TOK.to_str())
    spec["normalizer"] = {"type": "NFC"}
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    other = Tokenizer.from_file(path)
    got = K.encode_texts(["École, über".encode()], path)
    assert np.frombuffer(got[0], "<u4").tolist() == other.encode("École, über", add_special_tokens=False).ids


def test_a_word_of_a_million_letters():
    rnd = random.Random(5)
    word = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    assert MERGER.count_words([word]) == [len(ids(word))]


def test_fixture_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: len(ids(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in C.token_counts(docs, PATH).collect()} == want


@pytest.mark.parametrize("n,k", [(1, 1), (7, 3), (40, 5), (200, 40)])
def test_differencing_is_near_equal(n, k):
    sizes = np.random.default_rng(n).integers(1, 1000, n)
    w = K.differencing(sizes, k)
    load = np.bincount(w, weights=sizes, minlength=k)
    assert w.max() < k and load.sum() == sizes.sum()
    assert load.max() - load.min() <= sizes.max()


def test_windows_rise_until_capacity_holds():
    rng = np.random.default_rng(1)
    for sizes in (rng.integers(1, 1025, 500), np.full(9, 700), np.full(5, 1023), np.array([1])):
        w = K.pack_group(sizes, 1024)
        assert np.bincount(w, weights=sizes).max() <= 1024


@pytest.mark.parametrize("cfg", [K.PackConfig(), K.PackConfig(capacity=16, max_piece=5, group_pieces=20)])
def test_every_id_once_and_no_window_over_capacity(spark, stored, cfg):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "twice"), (3, "twice"), (None, "no id")]
    df = stored(rows, "doc_id long, text string")
    got = K.pack_documents(df, PATH, cfg, with_ids=True).collect()
    pieces = collections.Counter()
    for r in got:
        assert 0 < r.length <= cfg.capacity and len(r.ids) == r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        pieces[(r.doc_id, r.doc_tokens, r.start, tuple(r.ids))] += 1
    want = collections.Counter()
    for d, t in rows:
        x = ids(t) + [2]
        for s, n in K.cut(len(x), cfg):
            want[(d, len(x), s, tuple(x[s:s + n]))] += 1
    assert pieces == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= cfg.capacity


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = K.pack_documents(docs, PATH).selectExpr("sum(length) / (4096 * count(distinct sequence_id)) AS fill").first()
    assert r.fill > 0.97


def test_empty_table(spark, stored):
    df = stored([], "doc_id long, text string", 1)
    assert K.pack_documents(df, PATH).count() == 0
    assert C.token_counts(df, PATH).count() == 0
