"""Token counts by rank-synchronous array merging.

Byte-pair merging is usually done one sequence at a time. Here the pre-tokens of
many words are one ragged batch: a flat numpy array of symbol ids and the
sequence of each symbol. In every round each sequence finds the lowest rank among
its adjacent pairs and all sequences apply theirs at once, left to right
without overlap; sequences without a mergeable pair leave the batch, and what
is left of their symbols is their token count.

Merging a pair everywhere before looking again gives the same tokens as merging
one occurrence at a time: a new symbol can only take part in merges of a higher
rank than the one that made it.

A long pre-token (a script without blanks, generated letters) has thousands of ranks to
apply, so going over all of its symbols in each round would be quadratic. Sequences of
more than ``LONG_PIECE`` symbols keep their pairs in queues by rank instead: a round
takes the lowest rank of the batch, applies it everywhere and looks again only at the
neighbours of what it merged. The tokens are the same.

Scale: a narrow job (no shuffle). A worker keeps a bounded table of counts by
word, so a word of the language is merged once per worker, not once per use.
Texts are cut at ASCII white space, over which no pre-token of this tokenizer
family reaches, so whole texts are counted exactly.

Edge cases: a null or empty text has 0 bytes and 0 tokens. Strings of special
tokens inside a text count as one token each, as the library does by default.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

CACHE_WORDS = 500_000
LONG_PIECE = 256  # symbols; a choice of speed, both ways give the same tokens
NO_RANK = np.iinfo(np.int64).max


class RankMerger:
    """Counts tokens of words for a byte-level BPE tokenizer file (``.json``)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        tok = Tokenizer.from_file(path)
        self.normalizer, self.pre = tok.normalizer, tok.pre_tokenizer
        self.size = max(self.vocab.values()) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        right = np.array([self.vocab[b] for _, b in merges], np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]

    def pieces(self, word: str) -> tuple[list[str], int]:
        """Pre-tokens of a word (in the byte alphabet) and the special tokens in it."""
        n = 0
        parts = [word]
        for s in self.special:
            if s in word:
                split = [p.split(s) for p in parts]
                n += sum(len(x) - 1 for x in split)
                parts = [y for x in split for y in x]
        out: list[str] = []
        for p in parts:
            if p:
                text = self.normalizer.normalize_str(p) if self.normalizer is not None else p
                out += [x for x, _ in self.pre.pre_tokenize_str(text)]
        return out, n

    def symbols(self, piece: str) -> list[int]:
        v = self.vocab
        if not self.end:
            return [v[c] for c in piece]
        return [v[c] for c in piece[:-1]] + [v[piece[-1] + self.end]]

    def lookup(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), at

    def count_pieces(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(pieces), np.int64)
        long = [i for i, p in enumerate(pieces) if len(p) > LONG_PIECE]
        if long:
            out[long] = self.count_long([self.symbols(pieces[i]) for i in long])
        flat = [[] if len(p) > LONG_PIECE else self.symbols(p) for p in pieces]
        lens = np.fromiter(map(len, flat), np.int64, len(flat))
        sym = np.fromiter((s for x in flat for s in x), np.int64, int(lens.sum()))
        seq = np.repeat(np.arange(len(pieces)), lens)
        while len(sym):
            pair = seq[:-1] == seq[1:]
            rank, at = self.lookup(sym[:-1] * self.size + sym[1:])
            rank[~pair] = NO_RANK
            # one more entry, so that rank[i] belongs to symbol i and its successor
            rank = np.append(rank, NO_RANK)
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            done = low == NO_RANK
            out[seq[first[done]]] = size[done]
            low = np.repeat(low, size)
            hit = (rank == low) & (low != NO_RANK)
            # left to right without overlap: every other one of a run of neighbours
            idx = np.flatnonzero(hit)
            if len(idx):
                run = np.r_[True, np.diff(idx) != 1]
                start = idx[run][np.cumsum(run) - 1]
                idx = idx[(idx - start) % 2 == 0]
                sym[idx] = self.made[at[idx]]
            keep = np.repeat(~done, size)
            keep[idx + 1] = False
            sym, seq = sym[keep], seq[keep]
        return out

    def count_long(self, flat: list[list[int]]) -> np.ndarray:
        """Tokens of each sequence of symbols, lowest rank of all sequences first."""
        lens = np.fromiter(map(len, flat), np.int64, len(flat))
        n = int(lens.sum())
        sym = np.fromiter((s for x in flat for s in x), np.int64, n)
        # symbols as linked lists; n is before the first and after the last of a sequence
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        ends = np.cumsum(lens)
        nxt[ends - 1] = n
        prv[ends - lens] = n
        rank = np.full(n + 1, NO_RANK)
        made: dict[int, int] = {}
        queue: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Rank the pairs that begin at ``at`` and queue those that can merge."""
            rank[at] = NO_RANK
            at = at[nxt[at] < n]
            found, slot = self.lookup(sym[at] * self.size + sym[nxt[at]])
            rank[at] = found
            ok = np.flatnonzero(found != NO_RANK)
            ok = ok[np.argsort(found[ok], kind="stable")]
            cuts = np.flatnonzero(np.diff(found[ok])) + 1
            for group in np.split(ok, cuts) if len(ok) else ():
                r = int(found[group[0]])
                if r not in queue:
                    queue[r] = []
                    made[r] = int(self.made[slot[group[0]]])
                    heapq.heappush(order, r)
                queue[r].append(at[group])

        enter(np.arange(n))
        while order:
            r = heapq.heappop(order)
            idx = np.unique(np.concatenate(queue.pop(r)))
            idx = idx[rank[idx] == r]  # the others were merged or have a new neighbour
            if not len(idx):
                continue
            # left to right without overlap, as above
            run = np.r_[True, nxt[idx[:-1]] != idx[1:]]
            count = np.arange(len(idx))
            idx = idx[(count - np.maximum.accumulate(np.where(run, count, 0))) % 2 == 0]
            gone = nxt[idx]
            sym[idx] = made[r]
            rank[gone] = NO_RANK
            nxt[idx] = nxt[gone]
            prv[nxt[idx]] = idx
            before = prv[idx]
            enter(np.unique(np.concatenate([idx, before[before < n]])))
            lens -= np.bincount(np.searchsorted(ends, idx, side="right"), minlength=len(lens))
        return lens

    def count_words(self, words: list[str]) -> list[int]:
        """Tokens of each word (a text without ASCII white space)."""
        pieces: dict[str, int] = {}
        refs: list[int] = []
        sizes = np.zeros(len(words), np.int64)
        extra = np.zeros(len(words), np.int64)
        for i, w in enumerate(words):
            own, extra[i] = self.pieces(w)
            sizes[i] = len(own)
            refs += [pieces.setdefault(p, len(pieces)) for p in own]
        counts = self.count_pieces(list(pieces))[np.array(refs, np.int64)] if refs else np.zeros(0, np.int64)
        total = np.bincount(np.repeat(np.arange(len(words)), sizes), weights=counts, minlength=len(words))
        return (total.astype(np.int64) + extra).tolist()


_loaded: dict[str, tuple[RankMerger, dict[bytes, int]]] = {}


def _load(path: str) -> tuple[RankMerger, dict[bytes, int]]:
    if path not in _loaded:
        _loaded[path] = (RankMerger(path), {})
    return _loaded[path]


def text_counts(texts: list[bytes | None], merger: RankMerger, cache: dict[bytes, int]) -> list[int]:
    """Tokens of each UTF-8 text."""
    split = [(t or b"").split() for t in texts]
    if len(cache) > CACHE_WORDS:
        cache.clear()
    new = list(set().union(*split).difference(cache)) if split else []
    cache.update(zip(new, merger.count_words([w.decode("utf-8") for w in new])))
    return [sum(map(cache.__getitem__, words)) for words in split]


def token_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row: ``id, n_bytes, n_tokens, over_limit``. ``tokenizer_path`` must
    exist on every worker."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, cache = _load(tokenizer_path)
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            n = text_counts(texts, merger, cache)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(n, pa.int64())],
                ["id", "n_bytes", "n_tokens"])

    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]
    counted = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
