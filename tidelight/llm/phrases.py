"""Collocations by Toivonen's method: phrases proposed by a sample, counted exactly with their negative border.

1. One pass counts the words of all texts; the frequent ones are known exactly from then on.
2. A sample of short stretches of text proposes frequent phrases, level by level, at a support lowered for the sample's chance.
   Stretches are drawn one by one: a phrase that one long text or a group of copies repeats is as likely to be proposed as any other.
3. A full pass counts every phrase whose first and whose last words but one are both proposed (or frequent words). That is
   the proposed phrases and their negative border, as far as it occurs; the border is never enumerated. Most of the border is rare, so
   this pass sends ``SHORT`` bits of a phrase's key and its count instead of the phrase. Keys that are not frequent hold no frequent phrase;
   a further pass counts the phrases of the others by their text, so phrases that share a key are told apart.
4. A frequent phrase of the border is a failure: longer phrases around it were not counted. Then the failures join the
   proposals and an expansion pass counts what has become possible and was not counted. It takes all that it counts for frequent
   when it looks at the next length, so one such pass closes all lengths.

The result does not depend on the sample; only the number of passes does. Proposals are carried to the tasks as a bit map of
fixed size. A false hit in it makes a pass count a phrase in vain and changes no result, since counts go by language and phrase
themselves; a map that is too small for its proposals costs time only (raise ``map_bits``).

* Null and empty texts have no words, a null language is ``und``. A text of any length is read whole. Words never span pieces or texts.
* Repeated rows count each. Ties in the ranking go by count, then by the phrase in byte order, so the result is unique.
* An empty table gives no rows. Columns other than ``text``, ``lang`` and ``doc_id`` are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.llm import words as w
from tidelight.llm.grams import Words, byte_classes, chain, cut_words, pieces_of_texts, seeded
from tidelight.llm.tables import arrow_batches
from tidelight.session import settle

LONGEST = 5
CHUNK = 1 << 19
STRETCH = 32
SHORT = 40
PIECES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")


class KeyMap:
    """A set of 64-bit keys as a bit map of two probes; has false hits, never false misses."""

    def __init__(self, bits: int) -> None:
        self.shift = bits - 6
        self.slots = np.zeros(1 << self.shift, np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        mask, low = np.uint64(len(self.slots) - 1), np.uint64(63)
        first = self.slots[(keys >> np.uint64(64 - self.shift)).astype(np.int64)] >> (keys & low)
        second = self.slots[((keys >> np.uint64(12)) & mask).astype(np.int64)] >> ((keys >> np.uint64(6)) & low)
        return (first & second & np.uint64(1)) == 1

    def joined_by(self, keys: DataFrame) -> KeyMap:
        """This map and the keys of a column ``key``; Spark sends at most one number per slot."""
        probes = F.array(
            F.struct(F.shiftrightunsigned("key", 64 - self.shift).alias("slot"), F.col("key").bitwiseAND(63).alias("bit")),
            F.struct(
                F.shiftrightunsigned("key", 12).bitwiseAND(len(self.slots) - 1).alias("slot"),
                F.shiftrightunsigned("key", 6).bitwiseAND(63).alias("bit"),
            ),
        )
        marks = keys.select(F.explode(probes).alias("p")).select("p.slot", F.expr("shiftleft(1L, cast(p.bit AS int))").alias("mark"))
        found = marks.groupBy("slot").agg(F.bit_or("mark").alias("marks")).toArrow()
        out = KeyMap(self.shift + 6)
        out.slots = self.slots.copy()
        out.slots[found.column("slot").to_numpy()] |= found.column("marks").to_numpy().view(np.uint64)
        return out


def _language(df: DataFrame, *more: str) -> DataFrame:
    return df.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text", *more)


def _levels(langs: pa.Array, texts: pa.Array) -> tuple:
    """The words of the texts, the language of each row, and the keys of single words with the words' own hashes."""
    words = cut_words(texts, PIECES)
    coded, names = w.encode(langs)
    hashes = w.hash_strings(words.distinct)[words.code] if len(words) else np.zeros(0, np.uint64)
    seeds = w.hash_strings(names)[coded][words.owner] if len(words) else hashes
    return words, coded, names, hashes, seeded(seeds, hashes)


def sample_stretches(docs: DataFrame, share: int) -> DataFrame:
    """``lang`` and ``text``: stretches of at most ``STRETCH`` words of one piece, one in ``share`` drawn by a hash of row and place."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in pieces_of_texts(batches, "text", CHUNK):
            words = cut_words(part, PIECES)
            if not len(words):
                continue
            at = np.arange(len(words))
            new = np.append(True, words.piece[1:] != words.piece[:-1])
            new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % STRETCH == 0
            starts = np.flatnonzero(new)
            row = words.owner[starts]
            nth = np.arange(len(starts)) - np.searchsorted(row, row)
            seeds = batch.column("seed").to_numpy().view(np.uint64)[row]
            drawn = seeded(seeds, nth.astype(np.uint64)) % np.uint64(share) == 0
            sizes = np.diff(np.append(starts, len(words)))
            kept = words.distinct.take(pa.array(words.code[np.repeat(drawn, sizes)])).cast(pa.string())  # a chunk at most
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes[drawn])).astype(np.int32)), kept)
            coded, names = w.encode(batch.column("lang"))
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(coded[row[drawn]])).cast(pa.string()), pc.binary_join(lists, " ")], names=["lang", "text"]
            )

    rows = _language(docs.withColumn("seed", F.xxhash64("doc_id", "text")), "seed")
    return rows.mapInArrow(draw, "lang string, text string")


def _tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each key, and how often it occurs."""
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    return first, counts


def count_words(docs: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` (one word) and ``n`` of every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in pieces_of_texts(batches, "text", CHUNK):
            words = cut_words(part, PIECES)
            langs, names = w.encode(batch.column("lang"))
            for at in np.unique(langs):
                counts = np.bincount(words.code[langs[words.owner] == at], minlength=len(words.distinct))
                held = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[at].as_py()] * len(held), pa.string()), words.distinct.take(pa.array(held)).cast(pa.string()),
                     pa.array(counts[held].astype(np.int64))],
                    names=["lang", "phrase", "n"],
                )
            pa.default_memory_pool().release_unused()

    found = _language(docs).mapInArrow(count, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _short(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - SHORT)


@dataclass
class _Runs:
    """The different runs of ``size`` words of a chunk of texts that a pass counts."""

    size: int
    keys: np.ndarray
    counts: np.ndarray
    first: np.ndarray  # where a run of each key begins
    words: Words
    langs: pa.Array  # of each text

    def names(self, chosen: np.ndarray) -> pa.Array:
        """Language, tabulator and phrase of some of the runs."""
        first, distinct = self.first[chosen], self.words.distinct
        parts = [distinct.take(pa.array(self.words.code[first + step])) for step in range(self.size)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        lang = self.langs.take(pa.array(self.words.owner[first])).cast(pa.large_string())
        return pc.binary_join_element_wise(lang, phrase, pa.scalar("\t", pa.large_string())).cast(pa.string())


def _runs_of(batches: Iterator[pa.RecordBatch], new: KeyMap, old: KeyMap | None, only: int | None) -> Iterator[_Runs]:
    """The runs whose two parts but one word are in ``new``.

    Those that an earlier pass with the map ``old`` counted are left out, and all others are taken for wanted too at the
    next length. ``only`` is a single length.
    """
    for batch, part in pieces_of_texts(batches, "text", CHUNK):
        words, _, _, hashes, keys = _levels(batch.column("lang"), part)
        at = np.arange(len(words))
        held, before = new.has(keys), old.has(keys) if old else None
        for k in range(2, min(only or LONGEST, len(words)) + 1):
            # Runs of k - 1 words are held at ``at``; those of which the next is held too go on.
            here = np.flatnonzero((at[1:] == at[:-1] + 1) & held[1:] & held[:-1])
            end = at[here] + k - 1
            same = words.piece[end] == words.piece[at[here]]
            here, end = here[same], end[same]
            if not len(here):
                break
            keys_k = chain(keys[here], hashes[end])
            fresh = np.ones(len(here), bool)
            if old:
                fresh = ~(before[here] & before[here + 1])
                before = old.has(keys_k) & ~fresh  # a false hit of what was not counted does not count
            places = at[here]
            held_k = new.has(keys_k)
            if old:
                held_k |= fresh
            if fresh.any() and only in (None, k):
                chosen = np.flatnonzero(fresh)
                first, counts = _tally(keys_k[chosen])
                yield _Runs(k, keys_k[chosen[first]], counts, places[chosen[first]], words, batch.column("lang"))
            at, keys, held = places, keys_k, held_k
        pa.default_memory_pool().release_unused()


def count_keys(docs: DataFrame, wanted: KeyMap, only: int | None = None, short: bool = False) -> DataFrame:
    """``key`` and ``n`` of the phrases whose two parts but one word are ``wanted``, by whole or short keys."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _runs_of(batches, shared.value, None, only):
            keys = _short(runs.keys) if short else runs.keys
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(runs.counts.astype(np.int64))], names=["key", "n"])

    return _language(docs).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def count_phrases(docs: DataFrame, wanted: KeyMap, counted: KeyMap | None = None, among: KeyMap | None = None) -> DataFrame:
    """``lang``, ``phrase`` and ``n`` of the phrases whose two parts but one word are ``wanted``.

    Those that an earlier pass with the map ``counted`` counted are left out, and all others are taken for wanted too at the
    next length. ``among`` holds the spread short keys of all phrases that matter, if known.
    """
    maps = docs.sparkSession.sparkContext.broadcast((wanted, counted, among))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, old, named = maps.value
        for runs in _runs_of(batches, new, old, None):
            chosen = np.flatnonzero(named.has(w.mix(_short(runs.keys)))) if named else np.arange(len(runs.keys))
            if len(chosen):
                columns = [runs.names(chosen), pa.array(runs.counts[chosen].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["named", "n"])

    # One text of language, tabulator and phrase (which holds none) is a narrower key than two columns.
    found = _language(docs).mapInArrow(count, "named string, n long").groupBy("named").agg(F.sum("n").alias("n"))
    return found.select(F.expr("regexp_extract(named, '(?s)^(.*)\t', 1)").alias("lang"), F.substring_index("named", "\t", -1).alias("phrase"), "n")


@F.arrow_udf(T.LongType())
def _spread(keys: pa.Array) -> pa.Array:
    return pa.array(w.mix(keys.to_numpy().view(np.uint64)).view(np.int64))


@F.arrow_udf(T.LongType())
def _phrase_key(langs: pa.Array, phrases: pa.Array) -> pa.Array:
    words, _, _, hashes, keys = _levels(langs, phrases)
    starts = np.flatnonzero(np.append(True, words.owner[1:] != words.owner[:-1])) if len(words) else np.zeros(0, np.int64)
    size = np.diff(np.append(starts, len(words)))
    out = keys[starts]
    for step in range(1, int(size.max(initial=1))):
        longer = np.flatnonzero(size > step)
        out[longer] = chain(out[longer], hashes[starts[longer] + step])
    return pa.array(out.view(np.int64))


def _keys(phrases: DataFrame) -> DataFrame:
    return phrases.select(_phrase_key("lang", "phrase").alias("key"))


def _not_in(phrases: DataFrame, known: KeyMap) -> DataFrame:
    shared = phrases.sparkSession.sparkContext.broadcast(known)

    @F.arrow_udf(T.BooleanType())
    def held(keys: pa.Array) -> pa.Array:
        return pa.array(shared.value.has(keys.to_numpy().view(np.uint64)))

    return phrases.where(~held(_phrase_key("lang", "phrase")))


def sample_support(min_count: int, share: float, slack: float) -> int:
    """The count in a sample that few phrases of ``min_count`` occurrences stay below."""
    expected = min_count * share
    return max(2, math.floor(expected - slack * math.sqrt(expected)))


def frequent_phrases(
    docs: DataFrame, min_count: int = 100, share: int = 6, slack: float = 3.0, map_bits: int = 26
) -> tuple[DataFrame, DataFrame, int]:
    """All phrases of up to ``LONGEST`` words that occur ``min_count`` times or more, the words per language, and the
    number of times that phrases were counted: 1, or 2 with an expansion pass.

    The first has ``lang``, ``phrase``, ``n`` and ``k``, the number of words. The sample is one in ``share`` stretches; ``slack`` is
    by how many standard deviations its support is lowered.
    """
    with arrow_batches(docs.sparkSession, 8 * CHUNK):
        return _mine(docs, min_count, share, slack, map_bits)


def _mine(docs: DataFrame, min_count: int, share: int, slack: float, map_bits: int) -> tuple[DataFrame, DataFrame, int]:
    words = settle(count_words(docs))
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    single = words.where(F.col("n") >= min_count).select("lang", "phrase", "n")
    known = KeyMap(map_bits).joined_by(_keys(single))
    sample = settle(sample_stretches(docs, share))
    support = sample_support(min_count, 1 / share, slack)
    for k in range(2, LONGEST):  # what a proposal of the last level would add to the count is its border's
        proposed = settle(count_keys(sample, known, only=k).where(F.col("n") >= support).select("key"))
        if proposed.isEmpty():
            break
        known = known.joined_by(proposed)
    frequent = settle(count_keys(docs, known, short=True).where(F.col("n") >= min_count).select(_spread("key").alias("key")))
    found = settle(count_phrases(docs, known, among=KeyMap(map_bits).joined_by(frequent)).where(F.col("n") >= min_count))
    every, passes = single.unionByName(found), 1
    failures = _not_in(found.where(F.size(F.split("phrase", " ")) < LONGEST), known)
    if not failures.isEmpty():
        expanded = count_phrases(docs, known.joined_by(_keys(failures)), known)
        every, passes = every.unionByName(expanded.where(F.col("n") >= min_count)), 2
    return settle(every.withColumn("k", F.size(F.split("phrase", " ")))), settle(totals), passes


def _runs(phrase_words: str, shortest: int) -> str:
    """SQL of all runs of words of at least that many words that are shorter than the whole."""
    size = f"size({phrase_words})"
    return (
        f"flatten(transform(sequence({shortest}, {size} - 1), m -> transform(sequence(1, {size} - m + 1), "
        f"at -> array_join(slice({phrase_words}, at, m), ' '))))"
    )


def collocations(
    docs: DataFrame, min_count: int = 100, top: int = 2000, absorb_percent: int = 100, share: int = 6, slack: float = 3.0,
    map_bits: int = 26,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's best phrases.

    The score is floor(1000 a n / (l r)) at the cut where it is lowest (the first of equals), in exact decimals of 38 digits.
    A phrase gives way to a longer candidate that holds it and has at least ``absorb_percent`` percent of its count.
    """
    every, totals, _ = frequent_phrases(docs, min_count, share, slack, map_bits)
    longer = every.where("k > 1")
    inside = longer.where("k > 2").select(
        "lang", F.explode(F.expr(_runs("split(phrase, ' ')", 2))).alias("phrase"), F.col("n").alias("above")
    )
    above = inside.groupBy("lang", "phrase").agg(F.max("above").alias("above"))
    own = longer.join(above, ["lang", "phrase"], "left").where(f"above IS NULL OR 100 * above < {int(absorb_percent)} * n")
    cuts = own.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", F.expr("array_join(slice(w, 1, cut), ' ')").alias("left"),
        F.expr("array_join(slice(w, cut + 1, size(w) - cut), ' ')").alias("right"),
    )
    held = every.select("lang", F.col("phrase").alias("part"), F.col("n").alias("held"))
    cuts = cuts.join(held.withColumnsRenamed({"part": "left", "held": "l"}), ["lang", "left"])
    cuts = cuts.join(held.withColumnsRenamed({"part": "right", "held": "r"}), ["lang", "right"])
    cuts = cuts.join(F.broadcast(totals.withColumnRenamed("total", "n")), "lang")  # one row per language
    wide = "cast(cast({} AS decimal(19, 0)) * cast({} AS decimal(19, 0)) AS decimal(38, 0))".format
    score = F.expr(f"(cast({wide('a', 'n')} * 1000 AS decimal(38, 0))) div {wide('l', 'r')}")
    scored = cuts.select("lang", "phrase", "a", "l", "r", "n", "cut", score.alias("score"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
