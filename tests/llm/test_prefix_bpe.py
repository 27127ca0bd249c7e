import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexiflow.llm import prefix_bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
ENC = B.TextEncoder(PATH)
ODD = ["", " ", "  a", "a  b\n  c ", "\n foo <|endoftext|> bar<|endoftext|><|endoftext|>", "it's we'll  've '", "a" * 2000,
       "é中文字符😀👩‍👩‍👧 　x  y\x1c z\x85 w\xa0v", "１２３4 x\t\ty \r\n\r\n  z", "\x00\x01  \x1f a", "word " * 5000]


def library(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def ours(text):
    return [int(i) for i in next(ENC.encode([text])).split(",") if i]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert ours(text) == library(text)
    assert ENC.enc.decode(",".join(map(str, library(text)))) == TOK.decode(library(text), skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abc thein'ÀéT.,\n0 ", max_size=60)))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ours(text) == library(text)


def test_decoding_of_any_ids(spark, stored):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(50_300) for _ in range(rng.randrange(8))]) for i in range(300)] + [(None, None), (1, [])]
    df = stored(rows, "doc_id long, ids array<int>")
    got = Counter(tuple(r) for r in B.decode_documents(df, PATH).collect())
    assert got == Counter((r.doc_id, None if r.ids is None else TOK.decode(r.ids, skip_special_tokens=False)) for r in df.collect())


def test_long_word_is_linear():
    word = "".join(random.Random(1).choice("abcdefgh") for _ in range(200_000))
    assert ENC.enc.encode_piece(word.encode()) == library(word)


def test_automaton_finds_every_end():
    rng = random.Random(2)
    words = {bytes(rng.choices(b"ab", k=rng.randint(1, 6))) for _ in range(25)}
    auto = B.SuffixAutomaton(words)
    parts = {w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)} | {b""}
    text, s, n = bytes(rng.choices(b"ab", k=300)), 0, 0
    for i, c in enumerate(text, 1):
        while s > 0 and c not in auto.next[s]:
            s = auto.link[s]
            n = auto.length[s]
        s, n = (auto.next[s][c], n + 1) if c in auto.next[s] else (0, 0)
        assert n == max(len(p) for p in parts if text[:i].endswith(p))
        found, at = set(), s if n == auto.length[s] else auto.link[s]
        while at > 0:
            found |= {w for w, e in zip(words, auto.end) if e == at}
            at = auto.link[at]
        assert found == {w for w in words if text[:i].endswith(w)}


def test_made_up_merges(tmp_path):
    """Random merge lists, equal letters and tokens that merging never makes among them."""
    from tokenizers import models, pre_tokenizers

    rng = random.Random(7)
    for k in range(30):
        vocab, merges = {c: i for i, c in enumerate(B.byte_letters())}, []
        pool = list("abc")
        for _ in range(25):
            a, b = rng.choice(pool), rng.choice(pool)
            if a + b not in vocab and len(a + b) < 9:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
                pool.append(a + b)
        tok = Tokenizer(models.BPE(vocab, merges))
        tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        path = str(tmp_path / f"{k}.json")
        tok.save(path)
        enc = B.PrefixEncoder(path)
        for _ in range(150):
            w = "".join(rng.choices("abc", k=rng.randint(1, 14)))
            assert enc.encode_piece(w.encode()) == tok.encode(w).ids


def test_merges_out_of_order_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"].reverse()
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        B.PrefixEncoder(str(path))


def test_documents(spark, sf_dir, stored):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(80)
    odd = stored([(i, t) for i, t in enumerate(ODD)] + [(3, None), (None, "twice"), (None, "twice")], "doc_id long, text string")
    df = odd.unionAll(docs).selectExpr("*", "1 as id", "'x' as ids")
    out = B.encode_documents(df, PATH, with_ids=True)
    want = Counter((r.doc_id, tuple(library(r.text))) for r in df.collect())
    rows = out.collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    for r in rows:
        assert (r.n_tokens, r.ids_sha256) == (len(r.ids), sha(",".join(map(str, r.ids))))
        assert r.decoded_sha256 == sha(TOK.decode(r.ids, skip_special_tokens=False))
    assert B.encode_documents(df.where("false"), PATH).count() == 0


def test_small_word_tables_change_nothing():
    small = B.TextEncoder(PATH, word_bytes=1, piece_bytes=1)
    assert [list(small.encode([t])) for t in ODD] == [list(ENC.encode([t])) for t in ODD]


def test_settled_characters_are_cut_as_the_library_does():
    settled, other = B.unicode_patterns()
    chars = [c for c in map(chr, range(0x10000)) if not other.search(c)]
    assert len(chars) > 40_000 and other.search("😀") and other.search("\u200b")
    for start in range(0, len(chars), 500):
        text = "".join(f"a{c}1{c}{c}. {c} b  {c}'s" for c in chars[start:start + 500])
        assert settled.findall(text) == ENC.enc.pieces(text)


def test_each_pre_token_is_learned_once(monkeypatch):
    enc, learned = B.TextEncoder(PATH), []
    run = enc.enc.encode_pieces
    monkeypatch.setattr(enc.enc, "encode_pieces", lambda pieces: run(learned.extend(pieces) or pieces))
    texts = ["étude, étude. (étude) étude; 'étude'", "étude: étude! 😀étude étude😀 étude"]
    for _ in range(2):
        for text in texts:
            assert [int(i) for i in next(enc.encode([text])).split(",")] == library(text)
    assert len(learned) == len(set(learned)) and set(enc.words) == {" 😀étude", " étude😀"}


def test_prefixes_are_looked_at_only_when_asked_for(monkeypatch):
    enc, asked = B.PrefixEncoder(PATH), set()
    monkeypatch.setattr(enc, "_ends", lambda s, run=enc._ends: asked.add(s) or run(s))
    word = " international"
    assert enc.encode_piece(word.encode()) == library(word) and len(asked) < len(word)
