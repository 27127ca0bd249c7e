"""WARC archives and revisit resolution.

``write_archives`` stores rows as WARC 1.1 records, ``read_headers`` and
``read_records`` read them back. ``resolve_revisits`` shuffles record headers by
payload digest, takes the first record of each digest as the original response
and joins the others to it as revisits. ``write_deduplicated`` writes new
archives with fresh headers: a response keeps its payload, a revisit carries a
reference to the response and no payload.

Scale: digests are shuffled as headers, never with payloads; the original of a
digest is a partial aggregate (a payload that a third of all pages share sends
one row per task), and the join back to it is a shuffled join whose hot digests
AQE splits. Payloads move once, from the old archive to the new. Archives are
written by Spark's text writer (records end with two line breaks, which is the
WARC record end) to the shared folder and cut to about ``ARCHIVE_BYTES``, since
one archive is one unit of reading.

Edge cases: a null payload is empty; null ids and urls have no header; line
breaks in a url are percent-encoded; among records of equal payload and equal
id the one with the smaller record id is the response, and records without
an id come last. An empty table gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, write_table
from .common import bounded_batches, row_ids

ARCHIVE_BYTES = 16 << 20
RECORD_END = "\r\n\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: names that are URLs
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC record without the two line breaks that end it."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {_clean(v)}" for k, v in headers if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + block


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, by the stated lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, data[start:stop]
        at = stop + len(RECORD_END)


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP header."""
    if headers["WARC-Type"] != "response":
        return b""
    return block[block.index(b"\r\n\r\n") + 4:]


def _write_lines(lines: DataFrame, per_file: int, path: str) -> None:
    (lines.write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def records_per_file(df: DataFrame, text_col: str) -> int:
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    return max(1, int(ARCHIVE_BYTES * n / (size + 400 * n))) if n else 1


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> int:
    """A response record for each row of ``df`` (a stored table, see
    ``row_ids``); returns the records per file."""
    bounded_batches(df.sparkSession)
    src = row_ids(df.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"),
                            F.col(html_col).alias("html")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for pid, url, html, rid in zip(*(c.to_pylist() for c in (b.column(0), b.column(1),
                                                                    b.column(2).cast(pa.binary()), b.column(3)))):
                body = html or b""
                digest = payload_digest(body)
                out.append(record("response", [
                    ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{rid}|{pid}|{digest}')}>"),
                    ("WARC-Target-URI", url), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("X-Page-Id", pid), ("Content-Type", "application/http; msgtype=response")], HTTP + body))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])

    per_file = records_per_file(df, html_col)
    _write_lines(src.mapInArrow(run, "value string"), per_file, path)
    return per_file


HEADERS = "file string, idx bigint, record_type string, record_id string, page_id string, url string, payload_digest string, payload_bytes bigint, refers_to_record string"


def _read(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    # the name within the folder tells files apart; the content is parsed file by file
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def rows(file: str, content: bytes):
        for i, (h, block) in enumerate(parse(gzip.decompress(content))):
            body = payload_of(h, block)
            out = (file, i, h["WARC-Type"], h["WARC-Record-ID"], h.get("X-Page-Id"), h.get("WARC-Target-URI"),
                   h["WARC-Payload-Digest"].removeprefix("sha1:"), len(body), h.get("WARC-Refers-To"))
            yield out + ((body,) if with_payload else ())

    schema = HEADERS + (", payload binary" if with_payload else "")
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    kinds = {"idx": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                got = list(rows(b.column(0)[i].as_py(), b.column(1)[i].as_py()))
                for at in range(0, len(got), 500):
                    cols = list(zip(*got[at:at + 500]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kinds.get(k, pa.string())) for k, c in zip(names, cols)], names)

    return files.mapInArrow(run, schema)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, without payload; ``file`` and ``idx`` tell records apart."""
    return _read(spark, path, False)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record with its payload."""
    return _read(spark, path, True)


def resolve_revisits(headers: DataFrame, min_bytes: int = 0, id_type: str = "bigint") -> DataFrame:
    """Per record: ``file, idx, original_id, original_page, original_url``;
    the original is null for what stays a response. Archives hold ids as strings:
    ``id_type`` is the type whose order tells which is smallest (ids that are not of that
    type come after those that are, by their strings; null comes last)."""
    pid = F.col("page_id").try_cast(id_type)
    order = F.struct(F.col("page_id").isNull().alias("no_id"), pid.isNull().alias("other"), pid.alias("pid"),
                     "page_id", "record_id", "url")
    big = headers.where(F.col("payload_bytes") >= min_bytes)
    first = big.groupBy("payload_digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select("payload_digest", F.col("first.record_id").alias("original_id"),
                         F.col("first.page_id").alias("original_page"), F.col("first.url").alias("original_url"))
    later = big.join(first, "payload_digest").where(F.col("record_id") != F.col("original_id"))
    return later.select("file", "idx", "original_id", "original_page", "original_url")


def write_deduplicated(records: DataFrame, revisits: DataFrame, per_file: int, path: str) -> None:
    """New archives: ``records`` with fresh headers, those in ``revisits`` as
    revisit records without payload."""
    joined = records.join(revisits, ["file", "idx"], "left").select(
        "record_id", "page_id", "url", "payload_digest", "original_id", "original_url",
        F.when(F.col("original_id").isNull(), F.col("payload")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rid, pid, url, digest, first, first_url, body in zip(*(c.to_pylist() for c in b.columns)):
                fresh = f"<urn:uuid:{uuid.uuid5(NAMESPACE, 'deduplicated|' + rid)}>"
                same = [("WARC-Record-ID", fresh), ("WARC-Target-URI", url), ("WARC-Date", DATE),
                        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", pid)]
                if first is None:
                    out.append(record("response", [*same, ("Content-Type", "application/http; msgtype=response")],
                                      HTTP + body))
                else:
                    source = f"<urn:uuid:{uuid.uuid5(NAMESPACE, 'deduplicated|' + first)}>"
                    out.append(record("revisit", [*same, ("WARC-Profile", PROFILE), ("WARC-Refers-To", source),
                                                  ("WARC-Refers-To-Target-URI", first_url),
                                                  ("WARC-Refers-To-Date", DATE)], b""))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])

    _write_lines(joined.mapInArrow(run, "value string"), per_file, path)


def deduplicate_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      min_bytes: int = 0) -> tuple[DataFrame, str]:
    """Write ``pages`` as archives, resolve revisits, write deduplicated
    archives; returns what reading those back gives (one row per record:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``) and
    their folder."""
    spark = pages.sparkSession
    raw, out = scratch_path(spark, "warc"), scratch_path(spark, "warc-deduplicated")
    per_file = write_archives(pages, raw, id_col, url_col, html_col)
    kind = dict(pages.select(F.col(id_col).alias("id")).dtypes)["id"]
    revisits = write_table(resolve_revisits(read_headers(spark, raw), min_bytes, kind), "revisits")
    write_deduplicated(read_records(spark, raw), revisits, per_file, out)
    back = write_table(read_headers(spark, out), "warc-headers")
    full = back.where("record_type = 'response'")
    source = full.select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
                         F.col("payload_bytes").alias("full_bytes"))
    seen = back.where("record_type = 'revisit'").join(source, "refers_to_record", "left")
    cols = ["page_id", "payload_digest", "record_type"]
    rows = full.select(*cols, "payload_bytes", F.lit(None).cast("string").alias("refers_to")).unionByName(
        seen.select(*cols, F.col("full_bytes").alias("payload_bytes"), "refers_to"))
    return rows.select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to")), out
