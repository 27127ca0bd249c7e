"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents become token ids and an end id. Whole windows are cut off first; the
rest of each document (cut to pieces of at most ``max_piece``) is packed:
pieces are dealt at random into groups of bounded size, and each group is split
into k windows by multiway differencing. Every piece starts as a partial
partition (its length and k - 1 zeros); the two partial partitions of the largest
spread are merged again and again, the largest part of one with the smallest of
the other, so that imbalances cancel. k starts at the least number that could hold
the group and rises while the largest window is over capacity.

Scale: tokenising is a narrow job (ids leave the worker only as checksums, or
as arrays when asked for). Only (row, length) pairs are shuffled, to random
groups of ``group_pieces`` pieces on average: no key can make a group large, and
a window wastes no more when the input grows.

Edge cases: a null or empty text is the end id alone; repeated rows are packed
like any other; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, write_table
from .common import bounded_batches, row_ids
from .prefix_bpe import byte_letters
from .words import WordTable, runs

WORD_BYTES = 192 << 20
ENDING = b".,;:!?)"  # marks that are a pre-token of their own behind a letter a-z
#: Latin letters, all of them single code points in normal form, and ASCII marks but the apostrophe.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: The rules of a tokenizer file for which a word of that form is its letters, made small, and its marks.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


@dataclass(frozen=True)
class PackConfig:
    capacity: int = 4096
    end_id: int = 2
    max_piece: int = 1024
    group_pieces: int = 4096


# ------------------------------------------------------------------ tokens

_loaded: dict[str, tuple] = {}


class WordModel:
    """Ids of words (little-endian, unsigned 32-bit) by a tokenizer file.

    Most of the library's time for a word goes into its normalizer and pre-tokenizer. A word of
    Latin letters and marks behind them (``PLAIN``) is two pre-tokens whose form is known:
    the letters made small, and the marks. If the file has the rules for which that holds,
    the library's model is asked for the letters at once; other words take the whole way.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.model = self.tok.model
        self.plain = (spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == PRE_TOKENIZER and not spec["truncation"]
                      and not spec["post_processor"] and all(t["content"].startswith("<|") for t in spec["added_tokens"]))
        self.packed = [struct.pack("<I", i) for i in range(max(self.tok.get_vocab().values()) + 1)]
        # the letter of the byte alphabet for each byte, as codecs take it
        self.letters = "".join(c for c, _ in sorted(byte_letters().items(), key=lambda x: x[1]))

    def letter_ids(self, core: str) -> bytes:
        """Ids of a pre-token of small Latin letters."""
        if not core.isascii():
            core = charmap_decode(core.encode(), "strict", self.letters)[0]
        return b"".join([self.packed[t.id] for t in self.model.tokenize(core)])

    def learn(self, words: list[bytes], table: WordTable) -> None:
        """Ids of words, none of them in the table, into the table."""
        rest = []
        for w in words:
            m = PLAIN.fullmatch(w.decode("utf-8")) if self.plain else None
            if m is None:
                rest.append(w)
                continue
            if w in table:  # the letters of another word
                continue
            core, marks = m.groups()
            if not marks:
                enter(table, w, self.letter_ids(core.lower()))
                continue
            letters, marks = w[:-len(marks)], w[-len(marks):]
            if letters not in table:
                enter(table, letters, self.letter_ids(core.lower()))
            if marks not in table:
                self.learn_whole([marks], table)
            enter(table, w, table[letters] + table[marks])
        ended: dict[bytes, tuple[bytes, bytes]] = {}
        whole = set()
        for w in rest:
            core = w.rstrip(ENDING)
            if len(core) < len(w) and core and 97 <= core[-1] <= 122:
                ended[w] = core, w[len(core):]
                whole.update(ended[w])
            else:
                whole.add(w)
        self.learn_whole([w for w in whole if w not in table], table)
        for w, (core, marks) in ended.items():
            enter(table, w, table[core] + table[marks])

    def learn_whole(self, words: list[bytes], table: WordTable) -> None:
        """The same by normalizer, pre-tokenizer and model of the library."""
        for i in range(0, len(words), 5000):
            part = words[i:i + 5000]
            for w, e in zip(part, self.tok.encode_batch_fast([w.decode("utf-8") for w in part], add_special_tokens=False)):
                enter(table, w, struct.pack(f"<{len(e.ids)}I", *e.ids))


def enter(table: WordTable, word: bytes, ids: bytes) -> None:
    table[word] = ids
    table.bytes += 200 + len(word) + len(ids)


def _load(path: str) -> tuple[WordModel, WordTable]:
    if path not in _loaded:
        _loaded[path] = (WordModel(path), WordTable(WORD_BYTES))
    return _loaded[path]


def encode_texts(texts: list[bytes | None], path: str) -> list[bytes]:
    """Ids of each UTF-8 text as little-endian unsigned 32-bit, no special
    tokens added.

    Texts are cut at ASCII white space, which no pre-token of the word-end BPE
    contains, so each word's ids are computed once per worker (a table bounded in bytes)
    and a text's ids are its words' ids one after another. The tokenizer makes letters
    small, so words are compared without A-Z, unless a special token may be near; marks
    behind a letter a-z are pre-tokens of their own, so such a word is its two parts.
    """
    model, table = _load(path)
    table.make_room()
    split = [(t if b"<|" in t else t.lower()).split() if t else [] for t in texts]
    model.learn(list(filterfalse(table.__contains__, set().union(*split))), table)
    return [b"".join(map(table.__getitem__, words)) for words in split]


def cut(n: int, cfg: PackConfig) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: windows of
    full capacity, then pieces of at most ``max_piece``."""
    full = n // cfg.capacity * cfg.capacity
    out = [(s, cfg.capacity) for s in range(0, full, cfg.capacity)]
    return out + [(s, min(cfg.max_piece, n - s)) for s in range(full, n, cfg.max_piece)]


def piece_bounds(n: np.ndarray, cfg: PackConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``cut`` for many documents of ``n`` ids: document, start and length of each piece."""
    full = n // cfg.capacity
    rest = -(-(n - full * cfg.capacity) // cfg.max_piece)
    pieces = full + rest
    at = np.repeat(np.arange(len(n)), pieces)
    k = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    over = np.maximum(k - full[at], 0)  # pieces behind the whole windows
    start = np.minimum(k, full[at]) * cfg.capacity + over * cfg.max_piece
    most = np.where(k < full[at], cfg.capacity, cfg.max_piece)
    return at, start, np.minimum(most, n[at] - start)


PIECES = "rid bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def document_pieces(src: DataFrame, path: str, cfg: PackConfig = PackConfig(), with_ids: bool = False) -> DataFrame:
    """Pieces of the rows of ``src`` (id, text, _rid); the id travels with the
    row, so repeated or null ids need no join back. ``with_ids`` adds the ids
    of each piece as an array of int."""
    bounded_batches(src.sparkSession)
    kind = dict(src.dtypes)["id"]
    end = np.array([cfg.end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start = 0
            for texts in runs(b.column(1).cast(pa.binary()), 4 << 20):
                ids = [x + end for x in encode_texts(texts.to_pylist(), path)]
                at, first, size = piece_bounds(np.fromiter(map(len, ids), np.int64, len(ids)) // 4, cfg)
                crc = [zlib.crc32(memoryview(ids[i])[4 * s:4 * (s + m)]) for i, s, m in zip(at.tolist(), first.tolist(), size.tolist())]
                tokens = (np.fromiter(map(len, ids), np.int64, len(ids)) // 4)[at]
                rows = pa.array(at + start)
                arrays = [b.column(0).take(rows), b.column(2).take(rows), pa.array(first), pa.array(size), pa.array(crc, pa.int64()), pa.array(tokens)]
                names = ["id", "rid", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:  # pieces follow one another, so their ids are the texts' ids
                    flat = np.frombuffer(b"".join(ids), "<i4")
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)
                start += len(texts)

    return src.mapInArrow(run, f"id {kind}, {PIECES}" + (", ids array<int>" if with_ids else ""))


# ------------------------------------------------------------------ packing


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0..k-1) of each item by k-way Karmarkar-Karp differencing.

    A partial partition is a descending array of its non-zero parts less the
    smallest of k (zero unless all k are in use) and, beside it, the number of
    one item in each part; items of one part are joined in a forest.
    """
    n = len(sizes)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # (minus the spread, tie number, parts, item of each part)
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, a, ia = heapq.heappop(heap)
        _, _, b, ib = heapq.heappop(heap)
        both = max(0, len(a) + len(b) - k)  # parts that must share a window
        if both:
            # the smallest parts of one meet the largest of the other in opposite order
            tail = slice(len(a) - both, len(a))
            mate = slice(len(b) - both, len(b))
            a, joined = a.copy(), ib[mate][::-1]
            a[tail] += b[mate][::-1]
            for x, y in zip(ia[tail].tolist(), joined.tolist()):
                parent[root(y)] = root(x)
            b, ib = b[:len(b) - both], ib[:len(ib) - both]
        parts, items = np.concatenate([a, b]), np.concatenate([ia, ib])
        order = np.argsort(-parts, kind="stable")
        parts, items = parts[order], items[order]
        if len(parts) == k:
            parts = parts - parts[-1]
        heapq.heappush(heap, (-int(parts[0] - (parts[-1] if len(parts) == k else 0)), tie, parts, items))
        tie += 1
    roots = np.array([root(i) for i in range(n)])
    return np.unique(roots, return_inverse=True)[1]


def pack_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each piece; the number of windows rises until none is over capacity."""
    total = int(lengths.sum())
    k = max(1, -(-total // capacity))
    while True:
        if k >= len(lengths):
            return np.arange(len(lengths))
        w = differencing(lengths, k)
        over = int(np.bincount(w, weights=lengths).max()) - capacity
        if over <= 0:
            return w
        # the windows are near equal, so a share of the excess tells how many more are needed
        k += max(1, int(k * over / (capacity + over) / 2))


def place_pieces(pieces: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``."""
    cap = cfg.capacity
    full = pieces.where(F.col("length") == cap).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < cap)
    n_groups = max(1, -(-rest.count() // cfg.group_pieces))
    group = F.pmod(F.xxhash64("rid", "start"), F.lit(n_groups))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rid", "start"], kind="stable").reset_index(drop=True)
        w = pack_group(pdf["length"].to_numpy(np.int64), cap)
        pdf["sequence_id"] = (pdf["_group"].to_numpy(np.int64) << 32) | w
        before = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        pdf["offset"] = before.astype("int64")
        return pdf.drop(columns="_group")

    placed = rest.withColumn("_group", group).groupBy("_group").applyInPandas(
        pack, rest.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema)
    return full.unionByName(placed)


def pack_documents(df: DataFrame, tokenizer_path: str, cfg: PackConfig = PackConfig(), id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` (and ``ids``). ``df`` must be a stored table (see ``row_ids``)."""
    src = row_ids(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    pieces = write_table(document_pieces(src, tokenizer_path, cfg, with_ids), "pieces")
    cols = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if not with_ids:
        return place_pieces(pieces, cfg).select(F.col("id").alias(id_col), *cols)
    # ids stay out of the groups' tasks and meet their places at the end
    placed = write_table(place_pieces(pieces.drop("ids"), cfg).withColumnRenamed("rid", "_r").withColumnRenamed("start", "_s"), "places")
    found = pieces.select("rid", "start", "ids").join(
        broadcast_if_small(placed), (F.col("rid") == F.col("_r")) & (F.col("start") == F.col("_s")))
    return found.select(F.col("id").alias(id_col), *cols, "ids")
