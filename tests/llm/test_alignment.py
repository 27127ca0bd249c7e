import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lexiflow.llm import alignment as A

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TOK, MODEL = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
TOK.encode_special_tokens = True
ODD = ["", None, " ", "  a", " \n\t x", "a  b   c ", "foo <s> </s> <unk> <|endoftext|> <0x41>", "x▁y z", "▁", " ▁ a",
       "é中文字符😀👩‍👩‍👧 　x  y\x1c z\x85 w\xa0v ﬁ", "aaaa" * 50, "a\x00b c", "it's we'll", "trailing  ", "x \n y",
       "１２３4 x\t\ty \r\n\r\n  z", "a", "a a a", "q" * 3000 + " z" * 500]


def odd_texts():
    rng = random.Random(3)
    return ODD + ["".join(rng.choices("abc th ein  orsÀé▁ .,'\n0中😀", k=rng.randint(1, 25))) for _ in range(120)]


def spans(ids, pieces):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(pieces(i))))
        at = out[-1][1]
    return out


def a_bytes(i):
    return bytes(map(A.byte_letters().__getitem__, TOK.id_to_token(i)))


def b_bytes(i):
    piece = MODEL.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if MODEL.is_byte(i) else piece.replace("▁", " ").encode()


def brute(texts):
    docs = []
    for t in texts:
        a = TOK.encode(" " + t, add_special_tokens=False).ids if t else []
        b = MODEL.encode(t) if t else []
        raw = b" " + (t or "").encode()
        if not t or b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            docs.append(None)
            continue
        sa, sb, groups, low = spans(a, a_bytes), spans(b, b_bytes), [], 0
        for high in sorted({e for _, e in sa} & {e for _, e in sb}):
            groups.append([[i for i, (_, e) in zip(ids, s) if low < e <= high] for ids, s in ((a, sa), (b, sb))])
            low = high
        links = [(x, y) for x, (s, e) in zip(a, sa) for y, (u, v) in zip(b, sb) if u < e and s < v]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        docs.append((len(a), len(b), groups, links, hashlib.sha256(text.encode()).hexdigest()))
    n = Counter(p for d in docs if d for p in set(d[3]))
    most = {}
    for (a, _), c in n.items():
        most[a] = max(c, most.get(a, 0))
    return [(0,) * 6 + ("", 0) if d is None else (
        d[0], d[1], len(d[2]), len(d[3]), sum(n[p] == most[p[0]] for p in d[3]), sum(n[p] for p in d[3]), d[4],
        sum(len(x) * len(y) for x, y in d[2])) for d in docs]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 1500").limit(50)
    return odd_texts() + [r.text for r in docs.collect()]


@pytest.mark.parametrize("head_pairs", [1 << 20, 200, 0])
def test_documents(stored, texts, head_pairs):
    df = stored(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as id", "'x' as pairs", "2 as rid")
    out = A.align_documents(df, *PATHS, A.AlignConfig(head_pairs=head_pairs))
    assert [tuple(r)[1:] for r in out.orderBy("doc_id").collect()] == brute(texts)


def test_repeated_rows_null_ids_and_no_rows(stored):
    df = stored([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    rows = A.align_documents(df, *PATHS).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.count_sum) for r in rows) == [(0, 2, 6), (1, 2, 6), (1, 2, 6), (2, 0, 0)]
    assert A.align_documents(df.where("false"), *PATHS).count() == 0


def test_small_word_table_changes_nothing():
    big, small = A.Aligner(*PATHS, 1 << 30), A.Aligner(*PATHS, 1)
    for t in odd_texts()[:40]:
        one, two = big.align_texts([t or ""]), small.align_texts([t or ""])
        assert one[1] == two[1] and all(np.array_equal(x, y) for x, y in zip(one, two))


def test_product_is_the_matrix_product():
    rng = np.random.default_rng(5)

    def dense(m):
        out = np.zeros((len(m.ptr) - 1, m.width), np.int64)
        out[m.rows(), m.cols] = m.data
        return out

    def sparse(d):
        ptr = np.concatenate([[0], np.cumsum((d != 0).sum(1))])
        return A.Csr(ptr, np.nonzero(d)[1], d[d != 0], d.shape[1])

    for _ in range(50):
        n, k, m = rng.integers(1, 8, 3)
        x, y = (rng.integers(0, 4, s) * (rng.random(s) < 0.4) for s in ((n, k), (k, m)))
        assert np.array_equal(dense(sparse(x).times(sparse(y))), x @ y)
        assert np.array_equal(dense(sparse(x).transposed()), x.T)


def test_overlap_bytes_and_shared_groups():
    made = A.align(np.array([2, 3, 1, 4]), np.array([1, 4, 1, 2, 2]))
    # A: 0-2 2-5 5-6 6-10; B: 0-1 1-5 5-6 6-8 8-10; common ends 5, 6, 10
    assert list(zip(made.overlap.rows(), made.overlap.cols, made.overlap.data)) == [(0, 0, 1), (0, 1, 1), (1, 1, 3), (2, 2, 1), (3, 3, 2), (3, 4, 2)]
    shared = made.shared_group()
    assert list(zip(shared.rows(), shared.cols)) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 3), (3, 4)]
    assert list(made.together) == [2, 2, 1, 2]
