import base64
import gzip
import glob
import hashlib

from lexiflow.llm import warc as W


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


ROWS = [(5, "http://a/x", "<p>same</p>"), (2, "http://b/x", "<p>same</p>"), (2, "http://b/y", "<p>same</p>"),
        (9, None, None), (10, "u\r\nWARC-Type: x", ""), (None, "http://n", "<p>same</p>"), (11, "http://c", "a\r\n\r\nb\r\n\r\nWARC/1.1"),
        (12, "http://d", "é" * 70000)]


def test_round_trip_and_revisits(spark, stored):
    df = stored(ROWS, "page_id long, url string, html string").selectExpr("*", "'z' as file", "7 as idx", "'q' as payload")
    out, folder = W.deduplicate_pages(df)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out.collect())
    same = digest(b"<p>same</p>")
    want = [(i, len((h or "").encode()), digest((h or "").encode())) for i, _, h in ROWS]
    assert [g[:3] for g in got] == sorted((str(a), b, c) for a, b, c in want)
    # the smallest id is the response, a repeated row and a null id revisit it
    kinds = sorted((g[0], g[3], g[4]) for g in got if g[2] == same)
    assert kinds == sorted([("2", "response", None), ("2", "revisit", 2), ("5", "revisit", 2), ("None", "revisit", 2)])
    assert sorted(g[3:] for g in got if g[0] in ("9", "10")) == [("response", None), ("revisit", 9)]
    # archives are valid on their own: payloads appear once, ids are unique, references resolve
    records = [r for f in glob.glob(f"{folder}/*.gz") for r in W.parse(gzip.open(f).read())]
    ids = [h["WARC-Record-ID"] for h, _ in records]
    assert len(ids) == len(set(ids)) == len(ROWS)
    assert sum(W.payload_of(h, b) == b"<p>same</p>" for h, b in records) == 1
    full = {h["WARC-Record-ID"] for h, _ in records if h["WARC-Type"] == "response"}
    assert all(h["WARC-Refers-To"] in full and b == b"" for h, b in records if h["WARC-Type"] == "revisit")


def test_small_payloads_stay_responses(spark, stored):
    df = stored([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in W.deduplicate_pages(df, min_bytes=3)[0].collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_records_keep_payloads(spark, stored, tmp_path):
    df = stored(ROWS, "page_id long, url string, html string")
    W.write_archives(df, str(tmp_path / "w"))
    got = sorted((str(r.page_id), bytes(r.payload)) for r in W.read_records(spark, str(tmp_path / "w")).collect())
    assert got == sorted((str(i), (h or "").encode()) for i, _, h in ROWS)


def test_ids_of_other_types(spark, stored):
    df = stored([("b2", "u", "x"), ("b10", "u", "x"), ("10", "u", "x"), (None, "u", "x"), ("9", "u", "y")],
                "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in W.deduplicate_pages(df)[0].collect()}
    assert got == {"10": ("response", None), "b10": ("revisit", "10"), "b2": ("revisit", "10"), None: ("revisit", "10"),
                   "9": ("response", None)}
    heads = stored([("f", i, p, f"r{p}", "d", 3) for i, p in enumerate(["b2", "10", "9", None])],
                   "file string, idx long, page_id string, record_id string, payload_digest string, payload_bytes long")
    heads = heads.selectExpr("*", "'u' as url")
    assert {r.original_page for r in W.resolve_revisits(heads).collect()} == {"9"}
    assert {r.original_page for r in W.resolve_revisits(heads, id_type="string").collect()} == {"10"}


def test_one_very_long_payload(spark, stored):
    body = "word " * 4_000_000
    df = stored([(1, "u", body), (2, "u", body), (3, "u", "x")], "page_id long, url string, html string", 1)
    got = {r.page_id: (r.record_type, r.payload_bytes) for r in W.deduplicate_pages(df)[0].collect()}
    assert got == {1: ("response", len(body)), 2: ("revisit", len(body)), 3: ("response", 1)}


def test_empty_table(spark, stored):
    assert W.deduplicate_pages(stored([], "page_id long, url string, html string", 1))[0].count() == 0
