"""Toxicity by two class-conditional Kneser-Ney models.

A bigram model each of toxic and of ordinary labelled texts, with interpolated absolute discounts. Pairs count by the
distinct words before them, as the lower orders of Kneser-Ney models do, so that copies of a text count once. Both back
off to continuation counts of their class and these to counts of all documents. Pairs and words of every count are kept; the
discounts pass part of their mass on. Of a word that neither class holds, the shared count would be a factor of both
likelihoods and cancels in their ratio, so only the counts of the classes' words are gathered.

Averaged over a text, a few toxic words drown in a long ordinary one. So a second number stands beside the difference of the
log-likelihoods per word: the evidence of the ``PEAKS`` most toxic words of the text, by the same continuation counts, smoothed so that words
seen once say little. The score is the logistic function of both; slopes and offset are fitted on labelled texts that the models have not seen.

The models are fitted on a bounded sample: of each class equally many rows, in the order of a hash of their id, up to
``max_documents`` texts and ``max_bytes`` bytes of text. Counts behind the last backing-off cover all documents.
A text needs only the difference of both classes' logarithms: one number a pair of words that the sample holds, three a word.
These tables are made by joins and written to the shared folder, where the tasks read them; the driver sees a dozen sums.

* Null and empty texts have no words and the score of a difference and an evidence of 0. A label's ``doc_id`` may repeat: one
  toxic label makes a text toxic. Null labels are left out. Without labels of both classes every score is 0.5 or the share of toxic labels.
* Repeated rows have equal scores. Other columns are never read, whatever their names. A text of any length is read whole.
* Ties: texts are sampled by the hash of their id and then by the id. A score that rounds to a half is predicted 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.functions.storage import locate, qualify
from tidelight.llm import words as w
from tidelight.llm.tables import crc_of_id
from tidelight.session import settle, work_folder

FOLDS = 5
CALIBRATION_FOLD = 4
PEAKS = 3  # words whose evidence counts apart from the average
PRIOR_WORDS = 30  # words without a say that are added to each text, so that a few words alone decide little
_START = np.uint64(1)
_OUTER = ".,;:!?\"'()[]{}*#$%&|<>…"


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word, in lower case and without marks around it."""
    owner, found = w.split_words(pc.utf8_lower(w.whole(texts)))
    bare = pc.utf8_trim(found, characters=_OUTER)
    codes, distinct = w.encode(bare)
    filled = pc.not_equal(bare, "").to_numpy(zero_copy_only=False)
    return owner[filled], w.hash_strings(distinct)[codes[filled]] if len(distinct) else np.zeros(0, np.uint64)


def _before(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The hash of the word before each, or the start mark."""
    out = np.full(len(hashes), _START)
    if len(hashes):
        out[1:] = np.where(owner[1:] == owner[:-1], hashes[:-1], _START)
    return out


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return w.mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions in ``sorted_keys``, its length where missing."""
    at = np.searchsorted(sorted_keys, keys)
    hit = sorted_keys[np.minimum(at, max(0, len(sorted_keys) - 1))] == keys if len(sorted_keys) else np.zeros(len(keys), bool)
    return np.where(hit, at, len(sorted_keys))


@lru_cache(maxsize=2)
def _shelved(path: str) -> tuple[np.ndarray, ...]:
    """The columns of a table in the shared folder, sorted by the first, a hash; once in a worker process."""
    system, root = locate(path)
    columns = [c.to_numpy() for c in pq.read_table(root, filesystem=system).columns]
    order = np.argsort(columns[0].view(np.uint64))
    return columns[0].view(np.uint64)[order], *(c[order] for c in columns[1:])


def _shelve(df: DataFrame) -> str:
    folder = work_folder(df.sparkSession, "shelf")
    df.write.parquet(folder)
    return qualify(df.sparkSession, folder)


def _peaks(owner: np.ndarray, evidence: np.ndarray, rows: int) -> np.ndarray:
    """The sum of each text's ``PEAKS`` largest positive values."""
    some = np.flatnonzero(evidence > 0)
    owner, evidence = owner[some], evidence[some]
    order = np.lexsort((-evidence, owner))
    owner, evidence = owner[order], evidence[order]
    kept = np.arange(len(owner)) - np.searchsorted(owner, owner) < PEAKS
    return np.bincount(owner[kept], evidence[kept], minlength=rows).astype(np.float64)


@dataclass(frozen=True)
class Model:
    """Logarithms of toxic over ordinary: where the tables lie, and what holds for all words."""

    words: str  # hash, ``context`` (mass that a word passes on to what follows), ``lower`` (probability without context), ``evidence`` (smoothed, of the word alone)
    pairs: str  # hash, ``whole`` (probability of a pair that the sample holds)
    unknown: float  # probability without context of a word that the sample does not hold
    slopes: tuple[float, float] = (1.0, 0.0)  # of the ratio per word and of the evidence
    offset: float = 0.0

    def difference(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-likelihood ratio per word (toxic over ordinary), number of words, and evidence of the most toxic words of each text."""
        (words, context, lower, evidence), (pairs, whole) = _shelved(self.words), _shelved(self.pairs)
        owner, hashes = word_hashes(texts)
        before = _before(owner, hashes)
        pair = _find(pairs, _pair(before, hashes))
        word = _find(words, hashes)
        apart = np.append(context, 0.0)[_find(words, before)] + np.append(lower, self.unknown)[word]
        ratios = np.where(pair < len(pairs), np.append(whole, 0.0)[pair], apart)
        count = w.per_text(owner, None, len(texts))
        total = np.bincount(owner, ratios, minlength=len(texts)) if len(hashes) else np.zeros(len(texts))
        return total / (count + PRIOR_WORDS), count, _peaks(owner, np.append(evidence, 0.0)[word], len(texts))

    def compare(self, texts: Column) -> Column:
        """``llr``, ``n_words`` and ``peak`` of each text."""

        @F.arrow_udf("struct<llr:double,n_words:long,peak:double>")
        def difference(column: pa.Array) -> pa.Array:
            parts = [self.difference(part) for _, part in w.chunks(column)]
            llr, count, peak = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0), np.zeros(0, np.int64), np.zeros(0))
            columns = [pa.array(llr, pa.float64()), pa.array(count, pa.int64()), pa.array(peak, pa.float64())]
            return pa.StructArray.from_arrays(columns, ["llr", "n_words", "peak"])

        return difference(texts)


def training_rows(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``toxic``, ``fold`` and ``order`` of the labelled rows that may be learnt from."""
    one = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.pmod(crc_of_id(F.col("doc_id")), F.lit(FOLDS))
    return one.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), fold.alias("fold"),
                      F.xxhash64(F.lit(7), "doc_id").alias("order")).where("fold <> 0")


def _sample(docs: DataFrame, labels: DataFrame, max_documents: int, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Texts to fit and texts to calibrate on, each with ``toxic``."""
    rows = training_rows(labels)
    fits = F.col("fold") != CALIBRATION_FOLD
    sizes = {(row.toxic, row.fit): row.n for row in rows.groupBy("toxic", fits.alias("fit")).agg(F.count("*").alias("n")).collect()}
    chosen = None
    for toxic in (0, 1):
        for fit in (True, False):
            most = min(sizes.get((0, True), 0), sizes.get((1, True), 0), max_documents) if fit else max_documents
            part = rows.where((F.col("toxic") == toxic) & (fits == F.lit(fit))).orderBy("order").limit(most)
            part = part.withColumn("fit", F.lit(fit))
            chosen = part if chosen is None else chosen.unionByName(part)
    ids = F.broadcast(settle(chosen.select("doc_id", "toxic", "fit", "order")))  # at most 4 max_documents rows
    texts = settle(docs.select("doc_id", "text").join(ids, "doc_id"))
    lengths = texts.select("doc_id", "toxic", "fit", "order", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    over, total = [], {}
    for row in sorted(lengths.collect(), key=lambda row: (row.order, row.doc_id)):
        key = (row.toxic, row.fit)
        total[key] = total.get(key, 0) + row.bytes
        if total[key] > max_bytes and total[key] > row.bytes:  # the first text stays, whatever its size
            over.append(row.doc_id)
            total[key] -= row.bytes
    if over:  # at most 4 max_documents ids
        left_out = docs.sparkSession.createDataFrame([(doc_id,) for doc_id in over], lengths.select("doc_id").schema)
        texts = texts.join(F.broadcast(left_out), "doc_id", "left_anti")
    return texts.where("fit"), texts.where("NOT fit")


_COUNTS = "toxic int, history long, before long, word long"


def _find_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (class, the two words before, the word before, word) of each chunk."""
    for batch in batches:
        for start, part in w.chunks(batch.column("text")):
            toxic = batch.column("toxic").slice(start, len(part)).to_numpy(zero_copy_only=False).astype(np.uint64)
            owner, hashes = word_hashes(part)
            if not len(hashes):
                continue
            before = _before(owner, hashes)
            history = _pair(_before(owner, before), before)
            with np.errstate(over="ignore"):
                _, first = np.unique(_pair(_pair(history, hashes), toxic[owner]), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic[owner][first].astype(np.int32)), *(pa.array(x[first].view(np.int64)) for x in (history, before, hashes))],
                names=["toxic", "history", "before", "word"],
            )


def _discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


@F.arrow_udf(T.LongType())
def _pair_key(before: pa.Array, word: pa.Array) -> pa.Array:
    return pa.array(_pair(before.to_numpy().view(np.uint64), word.to_numpy().view(np.uint64)).view(np.int64))


def fit(docs: DataFrame, labels: DataFrame, max_documents: int = 4_000, max_bytes: int = 12_000_000) -> Model | None:
    """The models of a sample, backed off to counts of all ``docs``; None if a class has no words."""
    fitting, calibrating = _sample(docs, labels, max_documents, max_bytes)
    classes = (0, 1)
    pairs = settle(
        fitting.select("toxic", "text").mapInArrow(_find_pairs, _COUNTS).distinct().groupBy("before", "word").agg(
            *(F.sum((F.col("toxic") == y).cast("long")).alias(f"n{y}") for y in classes)
        )
    )
    total = [F.coalesce(F.sum(f"n{y}"), F.lit(0)).alias(f"n{y}") for y in classes]
    pair_sums = pairs.agg(*total, *_rare("n")).head()
    if not pair_sums.n0 or not pair_sums.n1:
        return None
    by_word = settle(pairs.groupBy("word").agg(*(F.sum((F.col(f"n{y}") > 0).cast("long")).alias(f"k{y}") for y in classes)))
    held = [F.sum((F.col(f"k{y}") > 0).cast("long")).alias(f"held{y}") for y in classes]
    word_sums = by_word.agg(*(F.sum(f"k{y}").alias(f"k{y}") for y in classes), *held, F.count("*").alias("words"), *_rare("k")).head()
    everywhere = settle(_count_everywhere(docs, _shelve(by_word.select("word"))))
    all_words = everywhere.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head().n

    # The discounts are below 1, so what they take away is one discount for each pair or word that occurs.
    flat, steep = ([_discount(sums[f"{c}{y}_1"], sums[f"{c}{y}_2"]) for y in classes] for c, sums in (("k", word_sums), ("n", pair_sums)))
    rest = [flat[y] * word_sums[f"held{y}"] / word_sums[f"k{y}"] for y in classes]
    shared = (F.coalesce("n", F.lit(0)) + 0.5) / F.lit(all_words + 0.5 * (word_sums.words + 1) + 1)  # the start mark is a word
    lower = [F.greatest(F.col(f"k{y}") - flat[y], F.lit(0.0)) / word_sums[f"k{y}"] + rest[y] * shared for y in classes]
    smooth = [F.ln((F.col(f"k{y}") + 1) / F.lit(float(word_sums[f"k{y}"] + word_sums.words))) for y in classes]
    words = by_word.join(everywhere, "word", "left").select(
        "word", *(lower[y].alias(f"lower{y}") for y in classes), (smooth[1] - smooth[0]).alias("evidence")
    )
    sums = (F.sum(f"n{y}").alias(f"t{y}") for y in classes)
    kinds = (F.sum((F.col(f"n{y}") > 0).cast("long")).alias(f"c{y}") for y in classes)
    passed = [F.when(F.col(f"t{y}") > 0, steep[y] * F.col(f"c{y}") / F.col(f"t{y}")).otherwise(1.0).alias(f"passed{y}") for y in classes]
    contexts = pairs.groupBy("before").agg(*sums, *kinds).select("before", "t0", "t1", *passed)
    whole = [
        F.greatest(F.col(f"n{y}") - steep[y], F.lit(0.0)) / F.greatest(f"t{y}", F.lit(1)) + F.col(f"passed{y}") * F.col(f"lower{y}")
        for y in classes
    ]
    known_pairs = pairs.join(contexts, "before").join(words, "word").select(
        _pair_key("before", "word").alias("pair"), (F.ln(whole[1]) - F.ln(whole[0])).alias("whole")
    )
    named = contexts.select(F.col("before").alias("word"), (F.ln("passed1") - F.ln("passed0")).alias("context"))
    both = named.join(words, "word", "full").select(
        "word", F.coalesce("context", F.lit(0.0)).alias("context"), F.coalesce(F.ln("lower1") - F.ln("lower0"), F.lit(0.0)).alias("lower"),
        F.coalesce("evidence", F.lit(0.0)).alias("evidence"),
    )
    model = Model(_shelve(both), _shelve(known_pairs), float(np.log(rest[1] / rest[0])))

    known = calibrating.select("toxic", model.compare("text").alias("c")).select("toxic", "c.llr", "c.peak").toArrow()  # at most 2 max_documents rows
    x, y = np.stack([known.column(c).to_numpy() for c in ("llr", "peak")], 1), known.column("toxic").to_numpy()
    if len(x) and 0 < y.sum() < len(y):
        by_class = training_rows(labels).groupBy("toxic").count().collect()
        share = {row.toxic: row["count"] for row in by_class}
        weight = np.where(y == 1, share[1] / y.sum(), share[0] / (len(y) - y.sum()))
        order = np.lexsort((*x.T, y))  # the same sums, however the rows arrive
        slopes, offset = _calibrate(x[order], y[order], (weight / weight.mean())[order])
        model = replace(model, slopes=slopes, offset=offset)
    return model


def _rare(name: str) -> list[Column]:
    """How many counts of each class are 1 and 2."""
    return [F.sum((F.col(f"{name}{y}") == c).cast("long")).alias(f"{name}{y}_{c}") for y in (0, 1) for c in (1, 2)]


def _count_everywhere(docs: DataFrame, known: str) -> DataFrame:
    """``word`` and ``n``: how often all ``docs`` hold each known word, and under a null word how many others they hold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words,) = _shelved(known)
        total = np.zeros(len(words) + 1, np.int64)
        for batch in batches:
            for _, part in w.chunks(batch.column("text")):
                total += np.bincount(_find(words, word_hashes(part)[1]), minlength=len(total))
        at = np.flatnonzero(total)
        hashes = pa.array(np.append(words, np.uint64(0))[at].view(np.int64), mask=at == len(words))
        yield pa.RecordBatch.from_arrays([hashes, pa.array(total[at])], names=["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Slope of each column and offset of a logistic regression, slightly held back."""
    middle, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (weight * (p - y)) + 0.1 * beta
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 3 / (np.abs(step).max() + 1e-12))
    slopes = beta[:-1] / scale
    return tuple(slopes.tolist()), float(beta[-1] - slopes @ middle)


def score(docs: DataFrame, labels: DataFrame, max_documents: int = 4_000, max_bytes: int = 12_000_000) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``llr`` (per word) and ``n_words`` of every row."""
    model = fit(docs, labels, max_documents, max_bytes)
    held_out = (F.pmod(crc_of_id(F.col("doc_id")), F.lit(FOLDS)) == 0).alias("held_out")
    if model is None:
        share = training_rows(labels).agg(F.coalesce(F.avg("toxic"), F.lit(0.5)).alias("share")).head().share
        return docs.select(
            "doc_id", held_out, F.lit(float(share)).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"),
            F.lit(0.0).alias("llr"), F.lit(None).cast("long").alias("n_words"),
        )
    odds = F.lit(model.slopes[0]) * F.col("c.llr") + F.lit(model.slopes[1]) * F.col("c.peak") + F.lit(model.offset)
    value = (1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-30.0)), F.lit(30.0))))).alias("score")
    scored = docs.select("doc_id", model.compare("text").alias("c")).select("doc_id", held_out, value, "c.llr", "c.n_words")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
