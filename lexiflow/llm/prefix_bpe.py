"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token there is exactly one token that can be the last of
its encoding. It is found among the tokens that the prefix ends with: the longest
one down to the shortest is put behind the stored last token of the prefix before
it, and the first pair that byte-pair merging would leave as it is wins. Following
the stored tokens back from the end gives the ids.

* The tokens that a prefix ends with come from a suffix automaton of the vocabulary:
  its state after a byte is the longest end of the prefix that occurs in any token, and
  the suffix links from there lead through all shorter ends that are tokens.
* Two tokens stay as they are (are compatible) when no merge reaches over their border
  in time. The pieces that touch the border are known at every time: on the left the
  token, its right half, that half's right half and so on, each from the moment of its
  merge to the next; on the right the same with left halves. The pairs that are there
  at the same time are looked up, from the last moment back to the first.

Scale: a narrow job without a shuffle. Every worker keeps the ids of pre-tokens in a
table bounded in bytes, so the programme runs once per pre-token, not per occurrence. Its
time is linear in a pre-token's length, so a text of one endless word is no special case.
Texts are cut into pre-tokens by a compiled pattern; words with a character of which the
library's version of Unicode may think otherwise are cut by the library.

Edge cases: a null text is taken as empty; an empty text has no ids, and its digests
are those of the empty string. Strings of special tokens inside texts become their
ids, as the library does by default. Rows are handled one by one, so repeated rows,
null ids and the names of other columns do not matter. Invalid UTF-8 made by decoding
arbitrary ids becomes U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .words import BLANK, WordTable, short_runs

WORD_BYTES = 48 << 20
PIECE_BYTES = 160 << 20
PAIRS = 1 << 19
NEVER = 1 << 40

#: Fixed value: the pre-token pattern of byte-level BPE files, for texts of ASCII alone.
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


#: White space that is not a separator by its Unicode category.
CONTROL_SPACE = frozenset("\t\n\v\f\r\x85")


def unicode_patterns() -> tuple[re.Pattern, re.Pattern]:
    """The pre-token pattern for texts of settled characters, and a pattern for any other
    character. Settled: in the basic plane and since Unicode 3.2 a letter, a number, white
    space or neither, so that no version that a library may have thinks otherwise."""
    settled: dict[str, list[str]] = {"L": [], "N": [], "Z": [], "": []}
    for c in map(chr, range(0x10000)):
        was, now = ("Z" if c in CONTROL_SPACE else u.category(c) for u in (unicodedata.ucd_3_2_0, unicodedata))
        kinds = {x[0] if x[0] in settled else "" for x in (was, now)}
        if len(kinds) == 1 and not {was, now} & {"Cn", "Cs"}:
            settled[kinds.pop()].append(c)
    letter, number, space, other = (re.escape("".join(x)) for x in settled.values())
    piece = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[{other}]+"
             f"|[{space}]+(?![^{space}])|[{space}]+")
    return re.compile(piece), re.compile(f"[^{letter}{number}{space}{other}]")


def byte_letters() -> dict[str, int]:
    """Letter of the byte alphabet -> byte: bytes that show stand for themselves, the
    others, in order, are the letters from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class SuffixAutomaton:
    """Suffix automaton of a set of byte strings."""

    def __init__(self, words: Iterable[bytes]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.end: list[int] = []  # state of each whole word
        for w in words:
            s = 0
            for c in w:
                s = self._extend(s, c)
            self.end.append(s)

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, c, known)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        """A state of its own for the strings of ``q`` that are no longer than ``p`` and ``c``."""
        short = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = short
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = short
            p = self.link[p]
        return short


class PrefixEncoder:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        tok = Tokenizer.from_file(path)
        if odd or tok.normalizer is not None or type(tok.pre_tokenizer).__name__ != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"not a plain byte-level BPE: {odd or 'normalizer or pre-tokenizer'}")
        self.pre = tok.pre_tokenizer
        self.letters = letters
        vocab: dict[str, int] = model["vocab"]
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.special: dict[str, int] = {}
        for t in spec.get("added_tokens", []):
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError(f"added token {t['content']!r} has matching rules of its own")
            self.special[t["content"]] = t["id"]
            self.bytes[t["id"]] = t["content"].encode()
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        # halves of each token, the time of its merge (-1: a byte), and the time of each pair
        self.halves: dict[int, tuple[int, int]] = {}
        self.made = dict.fromkeys(vocab.values(), -1)
        self.time: dict[tuple[int, int], int] = {}
        for at, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair, t = (vocab[a], vocab[b]), vocab[a + b]
            if t in self.halves or any(len(self.bytes[x]) > 1 and x not in self.halves for x in pair):
                raise ValueError(f"merge {at} comes before its halves, or makes {a + b!r} again")
            self.time[pair], self.halves[t], self.made[t] = at, pair, at
        self.known_pairs: dict[int, bool] = {}
        # a token is of use if merging its own bytes gives it
        whole = {i for i in self.made if i not in self.halves}
        for t, (a, b) in self.halves.items():  # in the order of the merges
            if a in whole and b in whole and self._stays(a, b, self.made[t]):
                whole.add(t)
        self.tokens = sorted(whole)
        self.automaton = SuffixAutomaton(self.bytes[t] for t in self.tokens)
        self.at_state = dict(zip(self.automaton.end, self.tokens))
        self.ends: dict[int, tuple[tuple[int, int], ...]] = {}
        self.size = {t: len(b) for t, b in self.bytes.items()}
        self.bytes_at = {str(t): b for t, b in self.bytes.items()}

    def _stays(self, a: int, b: int, joined: int = NEVER) -> bool:
        """No merge reaches over the border of ``a`` and ``b`` before the time ``joined``."""
        made, halves, time = self.made, self.halves, self.time
        a_gone = b_gone = joined  # when the piece at the border becomes part of a larger one
        while True:
            at = time.get((a, b), NEVER)
            # of equal pairs the left one is merged first
            if at < a_gone and (at <= b_gone if b_gone < joined else at < joined):
                return False
            if made[a] < 0 and made[b] < 0:
                return True
            if made[a] > made[b]:
                a_gone, a = made[a], halves[a][1]
            else:
                b_gone, b = made[b], halves[b][0]

    def compatible(self, a: int, b: int) -> bool:
        if len(self.known_pairs) >= PAIRS:
            self.known_pairs.clear()
        known = self.known_pairs[a << 32 | b] = self._stays(a, b)
        return known

    def _ends(self, s: int) -> tuple[tuple[int, int], ...]:
        """(token, length) of the tokens among the longest string of state ``s`` and its
        ends, longest first."""
        out = self.ends.get(s)
        if out is None:
            up = self._ends(self.automaton.link[s]) if s > 0 else ()
            own = self.at_state.get(s)
            out = self.ends[s] = up if own is None else ((own, self.automaton.length[s]), *up)
        return out

    def encode_pieces(self, pieces: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each pre-token with its ids, in the order of their bytes: what is known of a
        prefix serves all pre-tokens that begin with it. The last token of a prefix is looked
        for when a longer one asks for it, the whole pre-token first."""
        moves, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        size_of, pairs, ends = self.size, self.known_pairs, self.ends
        # by length of the prefix
        last = [-1]  # its last token (-1: not looked for yet)
        state = [0]  # of the automaton
        held = [0]  # length of the longest end that the state stands for
        before = b""
        for piece in sorted(pieces):
            i = 0
            for x, y in zip(before, piece):
                if x != y:
                    break
                i += 1
            del state[i + 1:], held[i + 1:], last[i + 1:]
            s, n = state[i], held[i]
            for c in piece[i:]:
                move = moves[s]
                while c not in move:
                    s = link[s]
                    n, move = length[s], moves[s]
                s = move[c]
                n += 1
                state.append(s)
                held.append(n)
            last += [-1] * (len(piece) - i)
            asked = [len(piece)] if piece else []
            while asked:
                i = asked[-1]
                s = state[i]
                full = s if held[i] == length[s] else link[s]
                for t, size in ends.get(full) or self._ends(full):
                    if size == i:
                        break
                    a = last[i - size]
                    if a < 0:
                        asked.append(i - size)
                        break
                    known = pairs.get(a << 32 | t)
                    if known or (known is None and self.compatible(a, t)):
                        break
                else:
                    raise AssertionError("every prefix has a last token")
                if asked[-1] == i:
                    last[i] = t
                    asked.pop()
            before = piece
            out, i = [], len(piece)
            while i:
                t = last[i]
                out.append(t)
                i -= size_of[t]
            out.reverse()
            yield piece, out

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        return next(self.encode_pieces([piece]))[1]

    def pieces(self, word: str) -> list[str]:
        """Pre-tokens of a word, as the library cuts it."""
        return [bytes(map(self.letters.__getitem__, p)).decode() for p, _ in self.pre.pre_tokenize_str(word)]

    def sections(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches between special tokens, and the special tokens with their ids."""
        for part in self.special_at.split(text) if self.special_at else [text]:
            if part:
                yield part, self.special.get(part)

    def decode(self, ids: str) -> str:
        """Text of decimal ids joined by commas, special tokens included."""
        return b"".join(map(self.bytes_at.__getitem__, ids.split(",") if ids else ())).decode("utf-8", "replace")


class TextEncoder:
    """Encodes batches of texts: each new pre-token of these once."""

    def __init__(self, path: str, word_bytes: int = WORD_BYTES, piece_bytes: int = PIECE_BYTES):
        self.enc = PrefixEncoder(path)
        self.settled, self.unsettled = unicode_patterns()
        # pre-tokens of words that the library cuts; ids of pre-tokens
        self.words, self.pieces = WordTable(word_bytes), WordTable(piece_bytes)

    def _cut(self, text: str) -> list[str]:
        """Pre-tokens of a stretch without special tokens."""
        if text.isascii():
            return ASCII_PIECE.findall(text)
        if not self.unsettled.search(text):
            return self.settled.findall(text)
        out: list[str] = []
        first, *rest = BLANK.split(text)
        for w in [first, *[" " + x for x in rest]]:
            if not self.unsettled.search(w):
                out += self.settled.findall(w)
                continue
            own = self.words.get(w)
            if own is None:
                self.words.make_room()
                own = self.words[w] = self.enc.pieces(w)
                self.words.bytes += 300 + 4 * len(w) + sum(80 + 4 * len(p) for p in own)
            out += own
        return out

    def _learn(self, pieces: Iterable[str]) -> None:
        """Decimal ids, joined by commas, of pre-tokens that are not in the table yet."""
        for p, ids in self.enc.encode_pieces([p.encode() for p in pieces]):
            piece = p.decode()
            self.pieces[piece] = text = ",".join(map(str, ids))
            self.pieces.bytes += 240 + 4 * len(piece) + len(text)  # key, value, slot

    def encode(self, texts: list[str]) -> Iterator[str]:
        """Decimal ids, joined by commas, of each text."""
        self.pieces.make_room()
        split: list[list[str | bytes]] = []
        for text in texts:
            pieces: list[str | bytes] = []
            for part, special in self.enc.sections(text):
                if special is None:
                    pieces += self._cut(part)
                else:  # as bytes, which no pre-token is
                    pieces.append(part.encode())
                    self.pieces[pieces[-1]] = str(special)
            split.append(pieces)
        self._learn(set().union(*split).difference(self.pieces))
        for pieces in split:
            yield ",".join(map(self.pieces.__getitem__, pieces))


_loaded: dict[str, TextEncoder] = {}


def _load(path: str) -> TextEncoder:
    if path not in _loaded:
        _loaded[path] = TextEncoder(path)
    return _loaded[path]


def encode_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Per row: ``id, n_tokens, ids_sha256`` (of the decimal ids joined by commas),
    ``decoded_sha256`` (of the text that the ids decode to), and with ``with_ids`` the
    ids. ``tokenizer_path`` must exist on every worker."""
    bounded_batches(df.sparkSession)
    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _load(tokenizer_path)
        for b in batches:
            n, ids_sha, text_sha, ids = [], [], [], []
            for part in short_runs(b.column(1)):
                for joined in enc.encode(part):
                    n.append(joined.count(",") + 1 if joined else 0)
                    ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                    text_sha.append(hashlib.sha256(enc.enc.decode(joined).encode()).hexdigest())
                    if with_ids:
                        ids.append(list(map(int, joined.split(","))) if joined else [])
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []),
                                             ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols) + with_ids])

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: ``id, text``, the text that an array of ids stands for (null: null). An id
    that the tokenizer does not have is left out, as the library does."""
    bounded_batches(df.sparkSession)
    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _load(tokenizer_path).enc
        for b in batches:
            texts = [None if x is None else enc.decode(",".join(str(i) for i in x if i in enc.bytes)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    out = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string")
    return out.withColumnRenamed("id", id_col)
