import hashlib
import zlib
from collections import Counter

import pytest

from lexiflow.llm import merkle as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(digests, fanout):
    """Root, and per leaf the siblings left and right of it at each level."""
    way, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, w in enumerate(at):
            run = level[w // fanout * fanout:][:fanout]
            way[i].append(("".join(run[:w % fanout]), "".join(run[w % fanout + 1:])))
            at[i] = w // fanout
        level = [sha(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], way


def brute(rows, fanout=16):
    groups = {}
    for r in rows:
        head = "".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars)))
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        seen = r.text.translate(LOWER) if hit and r.text is not None else r.text
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, sha(head, field(r.text)), sha(head, field(seen)), r.doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])], fanout) for s in names}
    root, tops = tree([trees[s][0] for s in names], fanout) if names else (None, [])
    out = []
    for s, top in zip(names, tops):
        for leaf, way in zip(sorted(groups[s]), trees[s][1]):
            h = leaf[3]
            for left, right in way + top:
                h = sha(left, h, right)
            out.append((leaf[4], leaf[2], trees[s][0], root, sha(*[a + b for a, b in way + top]), h, h == root))
    return Counter(out)


def got(df, **cfg):
    return Counter(tuple(r) for r in M.verify_documents(df, M.MerkleConfig(**cfg)).collect())


def test_fixture_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = got(docs)
    assert rows == brute(docs.collect())
    assert {r[6] for r in rows} == {True, False}


@pytest.mark.parametrize("fanout", [2, 16])
def test_odd_rows(spark, stored, fanout):
    rows = [(i, f"Text {i} É", "en", "hot", 3) for i in range(40)]
    rows += [(i, "A", None, f"s{i}", None) for i in range(19)]
    rows += [(None, None, None, None, None), (None, "b", None, None, 1), (5, "", "", "", 0), (5, "X", "l", "hot", 1),
             (7, "Same", "l", "hot", 1), (7, "Same", "l", "hot", 1), (9, "Long " * 50_000, "l", "é", 1), (9, "x", "l", "ｚ", 1), (9, "x", "l", "😀", 1)]
    df = stored(rows, SCHEMA)
    want = brute(df.collect(), fanout)
    clash = df.selectExpr("*", "1 as pos", "2 as gid", "'x' as digest", "3 as n", "4 as `group`", "5 as id")
    assert got(clash, fanout=fanout) == want


def test_one_row_and_no_row(spark, stored):
    one = stored([(5, "Ab", "en", "s", 2)], SCHEMA, 1)
    (row,) = M.verify_documents(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha()
    assert M.verify_documents(one.where("false")).count() == 0


def test_a_proof_fails_for_any_other_leaf(spark, stored):
    df = stored([(i, f"t{i}", "en", "s", i) for i in range(20)], SCHEMA)
    cols = [df[c] for c in ("doc_id", "text")]
    from pyspark.sql import functions as F
    out = M.verify(M.manifest(df, df["source"], df["doc_id"], cols, [cols[0], F.when(cols[0] == 3, F.lit("t")).otherwise(cols[1])]))
    assert [r.id for r in out.where("not verified").collect()] == [3]
