"""Fuzzy vocabulary join, best candidate, vocabulary corrector and the
correction chain (J1, J2, W3, M2, M3, T15-T18, P7).

The distance is the insert-1/delete-1/substitute-2 distance: the letters that have to
go from both words until they are equal. Words within distance D are found by an
equi-join on keys from their first letters alone.

Behind both words stand as many equal pad letters as needed. If x letters go from the
left word and y from the right one (x + y <= D), the same string c, pads included, is left of
both. Its first m letters are found, in order, among the first m + x letters of the left
word and among the first m + y of the right one. So for X = x and Y = D - x >= y, choosing m of
the first m + X letters of the left word in every way, and m of the first m + Y of the
right one, gives both at least one string in common. These strings, hashed together with X, are
the keys, for each X from 0 to D: C(m + X, X) of them on the left and C(m + Y, Y) on the
right, whatever the word's length. A pair found is measured, so neither equal keys of far
words nor equal hashes matter.

Words of more than ``LONG_WORD`` letters (strings that begin alike are usual among them)
are found by pieces instead: the right word is cut into D + 1
pieces, of which D edits leave at least one whole, at most D places away in the left
word. Pieces are joined on (length of the right word, piece number, hash), and the
pairs found are measured. This is exact too, with rows by D alone.

The best candidate is one number: candidates are numbered by frequency and name, and
distance and number are packed into a long, whose minimum is a plain hash aggregate.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import correct as C
from ..functions import edit as ED
from ..functions import text as T
from ..functions import typo as TY
from ..functions.util import let
from ..session import broadcast_if_small, spread_keys, write_table
from .encode import ROW_KEY, with_row_key
from .predict import Predictor, batch_predict
from .rank import global_row_number


#: So many left words are few: their keys may be broadcast.
FEW_WORDS = 10_000
#: Longest word that is joined by the keys of its first letters.
LONG_WORD = 32


def stop_word_anti_join(words: DataFrame, word_col: str, stop_words: DataFrame) -> DataFrame:
    """Rows whose word is not a stop word. A stop list within the broadcast
    bounds (checked) is broadcast; a larger one is shuffle-joined."""
    stop = stop_words.select(F.col("word").alias(word_col)).distinct()
    return words.join(_small(stop), word_col, "left_anti")


def key_letters(left_deletes: int, right_deletes: int) -> int:
    """Letters of a key: enough to be selective, as many more as both words lose. Near words have few
    keys, which may be long, so that a large vocabulary gives few pairs to measure."""
    return {1: 9, 2: 7}.get(left_deletes + right_deletes, max(2 * (left_deletes + right_deletes), 5)) + min(left_deletes, right_deletes)


def prefix_keys(w: Column, max_distance: int, left: bool, letters: Callable[[int, int], int] = key_letters) -> Column:
    """Keys of a word of the left or the right side (129 at distance 3, less repeated ones)."""
    ways = [(x, letters(x, max_distance - x), x if left else max_distance - x) for x in range(max_distance + 1)]
    p = max(m + own for _, m, own in ways)
    head = F.rpad(F.substring(w, 1, p), p, "\0")
    return let(F.transform(F.sequence(F.lit(1), F.lit(p)), lambda i: F.substring(head, i, F.lit(1))),
               lambda c: F.array_distinct(F.array(*[
                   F.xxhash64(F.lit(x), *[F.get(c, i) for i in kept])
                   for x, m, own in ways for kept in combinations(range(m + own), m)])))


def _piece_key(n: Column, k: Column, piece: Column) -> Column:
    """Key of piece ``k`` of a right word of ``n`` letters."""
    return F.xxhash64(n, k, piece)


def _piece_start(n: Column, k: Column, max_distance: int) -> Column:
    return F.floor(n * k / (max_distance + 1)).cast("int")


def _piece_numbers(max_distance: int) -> Column:
    return F.sequence(F.lit(0), F.lit(max_distance))


def _short(w: Column, keys: Column) -> Column:
    return F.when(F.length(w) <= LONG_WORD, keys).otherwise(F.array())


def _right_keys(w: Column, max_distance: int) -> Column:
    """Keys of a short word, and pieces of one that may be near a long word."""
    n = F.length(w)

    def piece(k):
        a, z = _piece_start(n, k, max_distance), _piece_start(n, k + 1, max_distance)
        return _piece_key(n, k, w.substr(a + 1, z - a))

    pieces = F.transform(_piece_numbers(max_distance), piece)
    return F.concat(_short(w, prefix_keys(w, max_distance, left=False)),
                    F.when(n > LONG_WORD - max_distance, pieces).otherwise(F.array()))


def _left_pieces(w: Column, max_distance: int) -> Column:
    """Where pieces of right words of the lengths in reach would stand in ``w``,
    for pairs with a long word."""
    n = F.length(w)
    lens = F.filter(F.sequence(n - max_distance, n + max_distance),
                    lambda m: (m > LONG_WORD - max_distance) & ((m > LONG_WORD) | (n > LONG_WORD)) & (m >= 0))

    def of_piece(m, k):
        a, z = _piece_start(m, k, max_distance), _piece_start(m, k + 1, max_distance)
        starts = F.filter(F.sequence(a - max_distance, a + max_distance), lambda s: (s >= 0) & (s + z - a <= n))
        return F.transform(starts, lambda s: _piece_key(m, k, w.substr(s + 1, z - a)))

    keys = F.flatten(F.transform(lens, lambda m: F.flatten(F.transform(
        _piece_numbers(max_distance), lambda k: of_piece(m, k)))))
    return F.when(n > LONG_WORD - max_distance, F.array_distinct(keys)).otherwise(F.array())


def key_index(right: DataFrame, right_col: str, max_distance: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """The right side of the fuzzy join: ``_r, _key`` = word and one of its keys (plus the
    ``carry`` columns of the word). It depends only on the vocabulary, so a job that
    corrects many batches builds it once (see ``stream_correct``)."""
    rw = spread_keys(right.select(F.col(right_col).alias("_r"), *carry).distinct(), "_r")
    return rw.select("_r", *carry, F.explode(_right_keys(F.col("_r"), max_distance)).alias("_key"))


def _key_matches(left: DataFrame, left_col: str, index: DataFrame, max_distance: int, hint: str = "merge",
                 few: bool = False) -> DataFrame:
    """Join rows ``_l, _d, index columns`` of left words and index words within the
    distance (a pair appears once per shared key; ``_d`` is its distance). ``few``: the keys of
    the left words are broadcast if they are within the checked bounds."""
    lw = spread_keys(left.select(F.col(left_col).alias("_l")).distinct(), "_l")
    l = F.col("_l")
    keys = F.concat(_short(l, prefix_keys(l, max_distance, left=True)), _left_pieces(l, max_distance))
    lv = lw.select("_l", F.explode(keys).alias("_key"))
    # Catalyst sizes an explode by its input, so both key tables look tiny and would be
    # broadcast although they hold dozens of rows per word. The hint keeps this a
    # shuffled join whose size is bounded per key (AQE still splits hot keys).
    side = broadcast_if_small(lv) if few else lv
    rows = (lv.hint(hint) if side is lv else side).join(index, "_key").where(F.abs(F.length("_l") - F.length("_r")) <= max_distance)
    return rows.withColumn("_d", ED.bounded_distance(l, F.col("_r"), max_distance)).where("_d is not null")


def fuzzy_vocab_join(left: DataFrame, left_col: str, right: DataFrame | None, right_col: str,
                     max_distance: int, right_out: str = "cand",
                     right_index: DataFrame | None = None) -> DataFrame:
    """All (left word, right word as ``right_out``, distance) with distance <= ``max_distance``.

    Duplicates of a pair (several shared keys) collapse in a partial aggregate.
    ``right_index`` (from ``key_index`` with the same ``max_distance``) replaces ``right``.
    """
    index = right_index if right_index is not None else key_index(right, right_col, max_distance)
    pairs = _key_matches(left, left_col, index.select("_r", "_key"), max_distance)
    best = pairs.groupBy("_l", "_r").agg(F.min("_d").alias("distance"))
    return best.select(F.col("_l").alias(left_col), F.col("_r").alias(right_out),
                       F.col("distance").cast("int").alias("distance"))


def best_candidate(pairs: DataFrame, word_col: str, cand_col: str, freq: DataFrame) -> DataFrame:
    """Per word, the candidate with the smallest distance, then the highest
    frequency, then the smallest candidate (a packed minimum, see ``ranked``)."""
    order = write_table(ranked(freq.select("word", "freq")), "candidate-ranks")
    scored = pairs.join(_small(order.select(F.col("word").alias(cand_col), "rank")), cand_col)
    best = scored.groupBy(word_col).agg(F.min(_packed(F.col("distance"), F.col("rank"))).alias("_b"))
    return _unpacked(best, order).select(word_col, "best", "distance")


#: Bits of a candidate's rank in a packed (distance, rank).
RANK_BITS = 48


def ranked(vocab: DataFrame) -> DataFrame:
    """``word, freq`` with ``rank``: 1 for the most frequent word, equal ones by name."""
    return global_row_number(write_table(vocab, "candidates"), [F.desc("freq"), F.col("word")], "rank")


def _packed(distance: Column, rank: Column) -> Column:
    return F.shiftleft(distance.cast("long"), RANK_BITS) + rank


def _unpacked(best: DataFrame, order: DataFrame) -> DataFrame:
    """``_b`` (a packed distance and rank) as ``best`` and ``distance``."""
    out = best.select("*", F.shiftright("_b", RANK_BITS).cast("int").alias("distance"),
                      F.col("_b").bitwiseAND(F.lit((1 << RANK_BITS) - 1)).alias("rank"))
    return out.join(_small(order.select("rank", F.col("word").alias("best"))), "rank").drop("rank", "_b")


@dataclass(frozen=True)
class CorrectConfig:
    detect_prompt: str = "detect typo:"
    correct_prompt: str = "correct typo:"
    head_mark: str = "$"
    tail_mark: str = "@"
    #: the gate; for the vocabulary corrector it is also the join distance, so
    #: every candidate that the gate would accept is looked for
    max_edit_distance: int | None = 3
    min_num_characters: int = 4
    min_freq: int = 1
    clean: bool = True
    locate_mode: str = "position"


def join_distance(cfg: CorrectConfig) -> int:
    if cfg.max_edit_distance is None:
        raise ValueError("the vocabulary corrector needs a max_edit_distance; without a limit every word is a candidate")
    return cfg.max_edit_distance


def _known(vocab: DataFrame, cfg: CorrectConfig) -> DataFrame:
    return vocab.where(F.col("freq") >= cfg.min_freq).select("word", "freq")


@dataclass(frozen=True)
class CandidateIndex:
    """What the best candidates are looked up in: the keys of the words (``_key, _r,
    rank``) and the words by rank (``rank, word, freq``)."""

    keys: DataFrame
    order: DataFrame
    hint: str = "merge"
    #: the keys are a table made once for many small lookups
    stored: bool = False


def candidate_index(vocab: DataFrame, max_distance: int) -> CandidateIndex:
    """Index over ``vocab`` (word, freq)."""
    order = write_table(ranked(vocab.select("word", "freq")), "candidate-ranks")
    return CandidateIndex(key_index(order, "word", max_distance, carry=("rank",)), order)


def vocabulary_index(vocab: DataFrame, cfg: CorrectConfig) -> CandidateIndex:
    """Index of the correction targets (known valid words)."""
    targets = _known(vocab, cfg).where(TY.valid_word(F.col("word"), cfg.min_num_characters))
    return candidate_index(targets, join_distance(cfg))


def nearest_known(left: DataFrame, left_col: str, index: CandidateIndex, max_distance: int) -> DataFrame:
    """J2 + W3 in one aggregate: per left word, ``best`` = the index word
    with the smallest distance, then the highest frequency, then the
    smallest word; ``distance`` its distance.

    Same result as ``best_candidate(fuzzy_vocab_join(...))``. The packed minimum is
    partially aggregated after the join, so no (word, candidate) pair list is
    shuffled or materialised.

    Unless the index is stored, the search goes by distance: words with a candidate at
    distance 1 (11 keys a word) have their best one and are done, then those at 2 (46 keys), and only the
    rest is looked up at ``max_distance`` (129 keys at 3). Few enough left words are
    broadcast then, so that the keys of the whole vocabulary are not shuffled for them.
    """
    if index.stored:
        found = _nearest(_key_matches(left, left_col, index.keys, max_distance, index.hint))
        return _unpacked(found, index.order).select(F.col("_l").alias(left_col), "best", "distance")
    rest = write_table(left.select(F.col(left_col).alias("_l")).distinct(), "words-to-find")
    found = None
    for distance in sorted({min(d, max_distance) for d in (1, 2)} | {max_distance}):
        last = distance == max_distance
        keys = index.keys if last else key_index(index.order, "word", distance, carry=("rank",))
        few = rest.count() <= FEW_WORDS
        at = write_table(_nearest(_key_matches(rest, "_l", keys, distance, index.hint, few)), "nearest")
        found = at if found is None else found.unionByName(at)
        if not last:
            rest = write_table(rest.join(at.select("_l"), "_l", "left_anti"), "words-to-find")
    return _unpacked(found, index.order).select(F.col("_l").alias(left_col), "best", "distance")


def _nearest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_l").agg(F.min(_packed(F.col("_d"), F.col("rank"))).alias("_b"))


def word_corrections(words: DataFrame, word_col: str, vocab: DataFrame, cfg: CorrectConfig,
                     index: CandidateIndex | None = None) -> DataFrame:
    """M3's decision per distinct word: unknown valid words with their best
    vocabulary candidate (``best`` null when none is close enough).
    ``index``: a prebuilt ``vocabulary_index(vocab, cfg)``."""
    known = _known(vocab, cfg)
    distinct = words.select(F.col(word_col).alias("word")).distinct().where(
        TY.valid_word(F.col("word"), cfg.min_num_characters))
    unknown = distinct.join(known.select("word"), "word", "left_anti")
    index = index if index is not None else vocabulary_index(vocab, cfg)
    best = nearest_known(unknown, "word", index, join_distance(cfg))
    return unknown.join(best.select("word", "best"), "word", "left")


def _small(df: DataFrame) -> DataFrame:
    return broadcast_if_small(df)


def word_flags(df: DataFrame, id_col: str, text: Column, words: Column, words_col: str, vocab: DataFrame,
               cfg: CorrectConfig, index: CandidateIndex | None = None) -> DataFrame:
    """Add ``words_col`` = ``words`` (an array made from ``text``) and, per row,
    ``_flags`` = sorted array of (pos, best) for unknown words; ids may repeat or be null.

    Distinct words go through the fuzzy join once; occurrences are matched to
    the (small) unknown-word table and regrouped per row id. Rows are
    hash-partitioned by (id, text) once, so the broadcast lookup, the regroup and the
    join back run without further exchanges; the arrays of words, several times the size of the
    text, are made after it.
    """
    part = with_row_key(df, id_col, text).repartition(ROW_KEY)
    ex = part.select(ROW_KEY, F.posexplode(words).alias("pos", "word"))
    ex = ex.where(TY.valid_word(F.col("word"), cfg.min_num_characters))
    # written once: the size check and the lookup then read files instead of
    # running the fuzzy join twice
    fixes = write_table(word_corrections(df.select(F.explode(words).alias("word")), "word", vocab, cfg, index), "word-fixes")
    hits = ex.join(_small(fixes), "word")
    flags = hits.groupBy(ROW_KEY).agg(F.sort_array(F.collect_set(F.struct("pos", "best"))).alias("_flags"))
    out = part.join(flags, ROW_KEY, "left").drop(ROW_KEY).withColumn(words_col, words)
    return out.withColumn("_flags", F.coalesce("_flags", F.array().cast("array<struct<pos:int,best:string>>")))


def _best_at(flags: Column, i: Column) -> Column:
    return F.get(F.transform(F.filter(flags, lambda s: s["pos"] == i), lambda s: s["best"]), 0)


def detect_output(words: Column, flags: Column, cfg: CorrectConfig) -> Column:
    """What a detector returns: the words with unknown ones marked."""
    return T.join_words(TY.mark_words(words, F.transform(flags, lambda s: s["pos"]),
                                      cfg.head_mark, cfg.tail_mark))


def correct_output(words: Column, flags: Column, cfg: CorrectConfig) -> Column:
    """What a corrector returns: marked words replaced by their best candidate
    (kept when there is none)."""
    h, t = cfg.head_mark, cfg.tail_mark

    def fix(ws, fl):
        n = F.size(ws)
        return F.transform(ws, lambda w, i: F.when(
            (F.get(ws, i - 1) == h) & (F.get(ws, i + 1) == t) & (i > 0) & (i < n - 1),
            F.coalesce(_best_at(fl, i), w)).otherwise(w))

    return T.join_words(let(words, lambda ws: let(flags, lambda fl: fix(ws, fl))))


def correct_table(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame,
                  cfg: CorrectConfig = CorrectConfig(), out_col: str = "corrected",
                  index: CandidateIndex | None = None) -> DataFrame:
    """M2 over a table with M3 as detector and corrector.

    clean -> detect -> correct -> gated replacement. The detector's positions and the
    corrector's words come from one lookup, and the corrector only looks for what the gate
    accepts, so by default they are applied as they are: a text that holds marks of its
    own is corrected like any other. With ``locate_mode="pair"`` the texts of the two
    models are made and parsed (prompt, marks, locating by pairs, extraction, gate), with
    all the consequences of that for repeated pairs and for marks in the text.
    ``cfg.clean=False`` is the serving variant without the
    cleaning step. ``index``: a prebuilt ``vocabulary_index(vocab, cfg)``.
    """
    text = T.typeset_clean(F.col(text_col)) if cfg.clean else F.col(text_col)
    flagged = word_flags(df, id_col, F.col(text_col), T.split_words(text), "_words", vocab, cfg, index)
    if cfg.locate_mode == "position":
        # the corrector's positions are known; marks in the text are words like any other
        known = F.filter("_flags", lambda s: s["best"].isNotNull())
        fixes = F.transform(known, lambda s: F.struct(s["pos"].alias("pos"), s["best"].alias("word")))
        result = T.join_words(C.replace_at(F.col("_words"), fixes))
        return flagged.select(*df.columns, result.alias(out_col))
    n_prompt = len(cfg.detect_prompt.split(" "))
    step1 = flagged.withColumn("_clean", text).select(
        "*",
        T.split_words(T.add_prompt(cfg.detect_prompt, F.col("_clean"))).alias("_detect_words"),
        detect_output(F.col("_words"), F.col("_flags"), cfg).alias("_detected"))
    # The corrector sees the detector's marked text; corrections come from the
    # word under each mark, so its flags are the sentence's flags shifted by
    # the marks inserted before each position.
    marked_words = T.split_words(F.col("_detected"))
    step2 = step1.select(
        "*",
        C.locate_marked(F.col("_detect_words"), marked_words, cfg.head_mark, cfg.tail_mark, n_prompt,
                        cfg.locate_mode).alias("_idx"),
        correct_output(marked_words, _shift_flags(F.col("_flags")), cfg).alias("_corrected_marked"))
    corrections = T.extract_marked(F.col("_corrected_marked"), cfg.head_mark, cfg.tail_mark)
    applied = C.apply_corrections(F.col("_detect_words"), F.col("_idx"), corrections, cfg.max_edit_distance)
    result = T.join_words(F.slice(applied, n_prompt + 1, F.greatest(F.size(applied) - n_prompt, F.lit(0))))
    return step2.select(*df.columns, result.alias(out_col))


def correct_with_models(df: DataFrame, text_col: str, detector: Callable[[], Predictor],
                        corrector: Callable[[], Predictor], cfg: CorrectConfig = CorrectConfig(),
                        out_col: str = "corrected") -> DataFrame:
    """M2 over a table with the user's own detect and correct models.

    The detector gets the prompted text and returns it with wrong words marked
    (``head word tail``, without the prompt); the corrector gets the prompted
    marked text and returns it with the marked words put right. Positions come from
    the detector's marks, corrections from the corrector's, in order; each
    passes the edit gate. Models never see a null. Narrow: no shuffle, and no id is needed. A word of the
    text that equals a mark counts as one, as the models themselves see it. Null
    texts and null predictions leave the text as it is.
    """
    text = T.typeset_clean(F.col(text_col)) if cfg.clean else F.col(text_col)
    n_prompt = len(cfg.detect_prompt.split(" "))
    base = df.select(F.struct("*").alias("_in"), text.alias("_clean"))
    base = base.withColumn("_prompted", T.add_prompt(cfg.detect_prompt, F.coalesce("_clean", F.lit(""))))
    found = batch_predict(base, "_prompted", detector, "_detected")
    found = found.withColumn("_detected", F.coalesce("_detected", "_clean", F.lit("")))
    found = found.withColumn("_ask", T.add_prompt(cfg.correct_prompt, F.col("_detected")))
    fixed = batch_predict(found, "_ask", corrector, "_fixed")
    words = T.split_words(F.col("_prompted"))
    idx = C.locate_marked(words, T.split_words(F.col("_detected")), cfg.head_mark, cfg.tail_mark, n_prompt, cfg.locate_mode)
    fixes = T.extract_marked(F.coalesce("_fixed", F.lit("")), cfg.head_mark, cfg.tail_mark)
    applied = C.apply_corrections(words, idx, fixes, cfg.max_edit_distance)
    result = let(applied, lambda a: T.join_words(F.slice(a, n_prompt + 1, F.greatest(F.size(a) - n_prompt, F.lit(0)))))
    return fixed.select("_in.*", F.when(F.col("_clean").isNotNull(), result).alias(out_col))


def _shift_flags(flags: Column) -> Column:
    """Positions of flagged words inside the marked word list (each earlier
    flagged word added two marks; the word itself sits after its head mark)."""
    return F.transform(flags, lambda s, k: F.struct((s["pos"] + 2 * k + 1).alias("pos"), s["best"].alias("best")))
