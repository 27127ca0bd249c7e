"""Alignment of two tokenizers by sparse products of token-byte incidence matrices.

A text is cut into tokens twice. Rows of matrix A are the tokens of the first
tokenizer, rows of B those of the second, columns are the bytes; both are kept in
compressed sparse rows built here. The product A·Bᵀ, row by row (Gustavson: the row of
a token is the sum of the rows of Bᵀ at its bytes), has an entry for every pair of
tokens that overlap, and the entry is the number of bytes they share. Byte offsets where
tokens of both end cut the text into groups; the product of the two token-group
incidence matrices links all tokens of a group.

The number of documents that hold an id pair linked tells how usual the link is: each
document gets the sum over its links, and how many of its links are the most usual of
their A id.

Scale: texts are cut at single blanks, over which neither tokenizer reaches, and a
worker keeps the alignment of words in arrays bounded in bytes; the matrices of a batch
hold its new words only. Tokens are found once: a document leaves the worker as counts
and its distinct id pairs, a written table. Pairs are counted by a grouped aggregation.
The most frequent pairs (at most ``head_pairs``) are broadcast as sorted arrays; the
rest, which few documents hold each, meet the documents' pairs in a shuffle. No table
that grows with the input is broadcast and no pair is dropped.

Edge cases: a null or empty text, and one whose tokens do not spell a blank and the text
in both tokenizers, has no tokens: zeros and an empty ``groups_sha256``. Repeated rows
count as documents of their own; null ids and names of other columns do not matter. Ties
for the most usual link all count. A long word is aligned like any other.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_table
from .common import bounded_batches
from .prefix_bpe import byte_letters
from .words import LONE_BLANK, WordTable, short_runs

#: An id pair as one number: A id * 2^32 + B id.
PAIR = 32


@dataclass(frozen=True)
class AlignConfig:
    word_bytes: int = 224 << 20
    head_pairs: int = 1 << 20


# ------------------------------------------------------------------ matrices


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (``size[0]`` of them), start[1], ..."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)


@dataclass(frozen=True)
class Csr:
    """A matrix in compressed sparse rows: row i has ``data`` at the columns
    ``cols[ptr[i]:ptr[i + 1]]``."""

    ptr: np.ndarray
    cols: np.ndarray
    data: np.ndarray
    width: int

    @staticmethod
    def intervals(size: np.ndarray) -> Csr:
        """Rows of ones on consecutive stretches of columns of the given sizes."""
        ptr = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        return Csr(ptr, np.arange(ptr[-1]), np.ones(ptr[-1], np.int64), int(ptr[-1]))

    @staticmethod
    def members(of: np.ndarray, width: int) -> Csr:
        """One entry in each row, at column ``of[i]``."""
        return Csr(np.arange(len(of) + 1), of, np.ones(len(of), np.int64), width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.cols, kind="stable")
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=self.width))]).astype(np.int64)
        return Csr(ptr, self.rows()[order], self.data[order], len(self.ptr) - 1)

    def row_terms(self, other: Csr) -> np.ndarray:
        """Terms of each row of the product, before equal columns are added up."""
        terms = np.concatenate([[0], np.cumsum(np.diff(other.ptr)[self.cols])])
        return terms[self.ptr[1:]] - terms[self.ptr[:-1]]

    def times(self, other: Csr) -> Csr:
        """The product by Gustavson's row form, for all rows at once: every entry (i, k)
        draws row k of ``other``, and terms of one (row, column) are added up."""
        size = np.diff(other.ptr)[self.cols]
        at = spans(other.ptr[self.cols], size)
        key = np.repeat(self.rows(), size) * other.width + other.cols[at]
        value = np.repeat(self.data, size) * other.data[at]
        key, place = np.unique(key, return_inverse=True)
        rows = key // max(other.width, 1)
        ptr = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(self.ptr) - 1))]).astype(np.int64)
        return Csr(ptr, key - rows * other.width, np.bincount(place, value, len(key)).astype(np.int64), other.width)


@dataclass(frozen=True)
class Alignment:
    """Links of the tokens of a run of words that follow one another."""

    overlap: Csr  # A tokens x B tokens: bytes shared
    group_a: np.ndarray  # group of each A token
    group_b: np.ndarray
    together: np.ndarray  # B tokens in the group of each A token

    def shared_group(self) -> Csr:
        """A tokens x B tokens: 1 where both lie in one group."""
        n = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        return Csr.members(self.group_a, n).times(Csr.members(self.group_b, n).transposed())


def align(size_a: np.ndarray, size_b: np.ndarray) -> Alignment:
    """Align two cuts of the same bytes, given the byte sizes of the tokens."""
    a, b = Csr.intervals(size_a), Csr.intervals(size_b)
    overlap = a.times(b.transposed())
    common = np.intersect1d(a.ptr[1:], b.ptr[1:], assume_unique=True)
    group_a, group_b = np.searchsorted(common, a.ptr[1:]), np.searchsorted(common, b.ptr[1:])
    n = len(common)
    together = Csr.members(group_a, n).row_terms(Csr.members(group_b, n).transposed())
    return Alignment(overlap, group_a, group_b, together)


# ------------------------------------------------------------------ tokenizers


class ByteTokens:
    """A byte-level BPE file of the tokenizers library, applied to a blank and the text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        self.bytes = [bytes(letters[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.sizes = [len(x) for x in self.bytes]
        self.size = np.array(self.sizes, np.int64)

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]


class PieceTokens:
    """A sentence model, which puts a blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            if " " in piece[1:].replace("▁", " ").lstrip(" ") or ("▁" in piece[1:] and set(piece) != {"▁"}):
                raise ValueError(f"piece {piece!r} reaches over a blank")
            self.bytes.append(raw)
        self.sizes = [len(x) for x in self.bytes]
        self.size = np.array(self.sizes, np.int64)

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


def spelled(ids: Iterable[int], table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


class Aligner:
    """Alignment of words, remembered. Word ``k`` of the table has counts in
    ``counts[k]``, its groups in ``groups[k]`` and its links (id pairs) from
    ``links_at[k]`` on in ``links``."""

    def __init__(self, path_a: str, path_b: str, word_bytes: int):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.words = WordTable(word_bytes)
        self._empty()

    def _empty(self) -> None:
        self.groups: list[str | None] = []  # None: not spelled alike by itself
        self.counts = np.zeros((0, 5), np.int64)  # A and B tokens, groups, links, group links
        self.links_at, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def align_words(self, words: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Per word: groups as text and counts; and the links of all, in order. A word whose
        tokens do not spell a blank and the word in both tokenizers gets None and zeros."""
        ids_a, ids_b = self.a.encode(words), self.b.encode(words)
        good = self._spelled_alike(words, ids_a, ids_b)
        groups: list[str | None] = [None] * len(words)
        counts = np.zeros((len(words), 5), np.int64)
        if not good:
            return groups, counts, np.zeros(0, np.int64)
        # all good words stand one after another in one pair of matrices; they start and
        # end together, so no link or group reaches from one into the next
        n_a, n_b = (np.array([len(ids[i]) for i in good], np.int64) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.concatenate([ids[i] for i in good]).astype(np.int64) for ids in (ids_a, ids_b))
        made = align(self.a.size[flat_a], self.b.size[flat_b])
        end_a = np.cumsum(n_a)
        last = made.group_a[end_a - 1] + 1  # groups up to the end of each word
        per_a = np.stack([np.diff(made.overlap.ptr), made.together])
        totals = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(per_a, 1)], 1)
        n_links, n_together = totals[:, end_a] - totals[:, end_a - n_a]
        counts[good] = np.stack([n_a, n_b, np.diff(last, prepend=0), n_links, n_together], 1)
        text = group_texts(flat_a, made.group_a, flat_b, made.group_b)
        at = 0
        for i, to in zip(good, last.tolist()):
            groups[i] = ";".join(text[at:to])
            at = to
        return groups, counts, flat_a[made.overlap.rows()] << PAIR | flat_b[made.overlap.cols]

    def _spelled_alike(self, words: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[int]:
        """Numbers of the words whose tokens spell a blank and the word in both."""
        raw = [b" " + w.encode() for w in words]
        size, joined = list(map(len, raw)), b"".join(raw)

        def all_spelled(ids, t):  # the same bytes in all, and in each word as many
            return (spelled(itertools.chain.from_iterable(ids), t.bytes) == joined
                    and [sum(map(t.sizes.__getitem__, x)) for x in ids] == size)

        if all_spelled(ids_a, self.a) and all_spelled(ids_b, self.b):
            return list(range(len(words)))
        return [i for i, r in enumerate(raw) if spelled(ids_a[i], self.a.bytes) == r == spelled(ids_b[i], self.b.bytes)]

    def _learn(self, words: list[str]) -> None:
        groups, counts, links = self.align_words(words)
        base = len(self.groups)
        self.words.update(zip(words, range(base, base + len(words))))
        self.groups += groups
        n = counts[:, 3]
        self.links_at = np.concatenate([self.links_at, len(self.links) + np.cumsum(n) - n])
        self.counts, self.links = np.concatenate([self.counts, counts]), np.concatenate([self.links, links])
        # key, number, slot, groups and counts; each array may be there twice while it grows
        self.words.bytes += sum(400 + 4 * len(w) + len(g or "") for w, g in zip(words, groups)) + 16 * len(links)

    def align_texts(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text: counts, digest of the groups, number of distinct id pairs; the pairs
        of all texts in order, and how many links each stands for."""
        if self.words.make_room():
            self._empty()
        split = [LONE_BLANK.split(t) if t else [] for t in texts]
        new = {w for w in set().union(*split) if w not in self.words}
        if new:
            self._learn(list(new))
        counts, digests = np.zeros((len(texts), 5), np.int64), []
        number = [np.fromiter(map(self.words.__getitem__, s), np.int64, len(s)) for s in split]
        whole_links: list[tuple[int, np.ndarray]] = []
        for i, at in enumerate(number):
            known = [self.groups[k] for k in at.tolist()]
            if None in known:  # words may lean on one another: the text as one word tells
                known, c, links = self.align_words([texts[i]])
                counts[i] = c[0]
                whole_links.append((i, links))
                number[i] = at[:0]
            digests.append(hashlib.sha256(";".join(known).encode()).hexdigest() if known and known != [None] else "")
        flat = np.concatenate(number) if number else np.zeros(0, np.int64)
        text_of = np.repeat(np.arange(len(texts)), [len(x) for x in number])
        np.add.at(counts, text_of, self.counts[flat])
        n = self.counts[flat, 3]
        links = np.concatenate([self.links[spans(self.links_at[flat], n)], *[x for _, x in whole_links]])
        text_of = np.concatenate([np.repeat(text_of, n), *[np.full(len(x), i) for i, x in whole_links]]).astype(np.int64)
        ids, code = np.unique(links, return_inverse=True)
        key, times = np.unique(text_of * max(len(ids), 1) + code, return_counts=True)
        text_of = key // max(len(ids), 1)
        return counts, digests, np.bincount(text_of, minlength=len(texts)), ids[key - text_of * len(ids)], times


def group_texts(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray) -> list[str]:
    """``a1,a2|b1`` of each group."""
    def joined(ids: np.ndarray, group: np.ndarray) -> list[str]:
        text, first = list(map(str, ids.tolist())), np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        return [text[s] if e == s + 1 else ",".join(text[s:e]) for s, e in zip(first, [*first[1:], len(text)])]

    return [x + "|" + y for x, y in zip(joined(a, group_a), joined(b, group_b))]


# ------------------------------------------------------------------ jobs

_loaded: dict[tuple, Aligner] = {}


def _load(path_a: str, path_b: str, word_bytes: int) -> Aligner:
    key = path_a, path_b, word_bytes
    if key not in _loaded:
        _loaded[key] = Aligner(*key)
    return _loaded[key]


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


def linked_pairs(df: DataFrame, path_a: str, path_b: str, cfg: AlignConfig, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id``, the counts, ``groups_sha256``, its distinct id pairs (``pairs``) and
    how many links each stands for (``times``)."""
    bounded_batches(df.sparkSession)
    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _load(path_a, path_b, cfg.word_bytes)
        for b in batches:
            at = 0
            for texts in short_runs(b.column(1)):
                counts, digests, n_pairs, pairs, times = aligner.align_texts(texts)
                ptr = pa.array(np.concatenate([[0], np.cumsum(n_pairs)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), *[pa.array(counts[:, k]) for k in range(5)], pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(ptr, pa.array(pairs, pa.int64())), pa.ListArray.from_arrays(ptr, pa.array(times, pa.int32()))],
                    ["id", *COUNTS, "groups_sha256", "pairs", "times"])
                at += len(texts)

    longs = ", ".join(f"{c} bigint" for c in COUNTS)
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, {longs}, groups_sha256 string, pairs array<bigint>, times array<int>")


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, n_docs, best``: documents that hold an id pair linked, and whether no other
    pair of its A id is held by more."""
    counts = linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = write_table(counts.withColumn("a", F.shiftright("pair", PAIR)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def head_bound(counts: DataFrame, most: int) -> int:
    """The least number of documents such that at most ``most`` pairs have as many."""
    # one row for each number of documents that occurs: at most sqrt(2 * links) of them
    rows = counts.groupBy("n_docs").agg(F.count(F.lit(1)).alias("n"))
    up = Window.orderBy(F.desc("n_docs"))
    fits = rows.select("n_docs", F.sum("n").over(up).alias("so_far")).where(F.col("so_far") <= most)
    least = fits.agg(F.min("n_docs")).first()[0]
    return least if least is not None else (1 << 62)


def score_pairs(linked: DataFrame, counts: DataFrame, cfg: AlignConfig) -> DataFrame:
    """``linked`` with ``n_best`` and ``count_sum`` instead of its pairs. Both must be
    written tables; ``linked`` has a row number ``rid``."""
    spark = linked.sparkSession
    bound = head_bound(counts, cfg.head_pairs)
    head = counts.where(F.col("n_docs") >= bound).orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast([head.column(c).to_numpy() for c in ("pair", "n_docs", "best")])
    tail = counts.where(F.col("n_docs") < bound)
    whole = tail.isEmpty()
    columns = ["rid", "id", *COUNTS, "groups_sha256"]
    kinds = dict(linked.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns)

    def flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, pair and number of links of every pair of a batch; its place in the head
        and whether it is there."""
        size = np.diff(b.column("pairs").offsets.to_numpy())
        pairs, times = b.column("pairs").flatten().to_numpy(), b.column("times").flatten().to_numpy().astype(np.int64)
        keys = table.value[0]
        at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
        return np.repeat(np.arange(len(b)), size), pairs, times, at, keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, n_docs, best = table.value
        for b in batches:
            row, _, times, at, hit = flat(b)
            count_sum, n_best = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            np.add.at(count_sum, row[hit], times[hit] * n_docs[at[hit]])
            np.add.at(n_best, row[hit], times[hit] * best[at[hit]])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(n_best), pa.array(count_sum)],
                                             [*columns, "n_best", "count_sum"])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, pairs, times, _, hit = flat(b)
            yield pa.RecordBatch.from_arrays([b.column("rid").take(pa.array(row[~hit])), pa.array(pairs[~hit]), pa.array(times[~hit])],
                                             ["rid", "pair", "times"])

    out = linked.mapInArrow(sums, schema + ", n_best bigint, count_sum bigint")
    if whole:
        return out
    # pairs beyond the head, each held by fewer than ``bound`` documents
    left = linked.select("rid", "pairs", "times").mapInArrow(rest, "rid bigint, pair bigint, times bigint")
    more = left.join(tail.hint("merge"), "pair").groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("more_sum"))
    out = out.join(more, "rid", "left")
    return out.select(*columns, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def align_documents(df: DataFrame, path_a: str, path_b: str, cfg: AlignConfig = AlignConfig(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256,
    n_group_links``. The files must exist on every worker: ``path_a`` a byte-level BPE of
    the tokenizers library, ``path_b`` a sentence model."""
    linked = write_table(linked_pairs(df, path_a, path_b, cfg, id_col, text_col)
                         .withColumn("rid", F.monotonically_increasing_id()), "linked-pairs")
    counts = write_table(pair_counts(linked), "pair-scores")
    return score_pairs(linked, counts, cfg).select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")
