"""Mixing documents to target weights of soft domains.

A naive Bayes classifier over hashed words and word shapes is counted from all labelled texts of the even half of the ids'
checksums; the mean log-likelihoods per word and class that it gives are turned into domain posteriors by a multinomial
logistic regression on labelled texts of the odd half. A document then has expected tokens in every domain: its words times
its posterior. Rates (how often to use a document) are fitted by projected-gradient least squares, so that the
expected domain totals under the rates meet the targets, with no rate below 0.

The gradient of a rate is its document's posterior times the residuals of the domain totals, divided by the natural
totals, and by the document's words (a diagonal scaling, which projection onto the nonnegative orthant allows). The state
of a round is one residual per domain; every round is one aggregation over a narrow table of posteriors.

* Null and empty texts have no tokens and the rate 1; their posterior is that of a text about which nothing is known.
* Labels without ``doc_id`` or domain are left out. Without labels of some domain its posterior is only the smoothing's. Repeated rows
  have equal rates. An empty table gives no rows.
* Other columns are not read by :func:`fit_rates`; in :func:`mix_documents` they pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.llm import words as w
from tidelight.llm.tables import SMALL_BATCH, arrow_batches, crc_of_id, fresh
from tidelight.session import settle

CELLS = 1 << 18
_OUTER = ".,;:!?\"'()[]{}*#$%&|<>…"
_SHAPE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of two tokens per word: the bare word in lower case, and the shape (capitals, marks behind)."""
    owner, found = w.split_words(texts)
    if not len(found):
        return owner, np.zeros(0, np.int64)
    codes, distinct = w.encode(found)
    lower = pc.utf8_lower(distinct)
    bare = pc.utf8_trim(lower, characters=_OUTER)
    hashes = w.hash_strings(bare)
    capitals = pc.and_(pc.equal(pc.utf8_upper(distinct), distinct), pc.not_equal(lower, distinct))
    marks = pc.match_substring_regex(distinct, r"[*#$%&|<>!?]{2,}$")
    shape = capitals.to_numpy(zero_copy_only=False) + 2 * marks.to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.minimum(pc.utf8_length(bare).to_numpy(zero_copy_only=False), 30)
    shapes = w.mix((shape * 31 + length + 1).astype(np.uint64))
    both = np.stack([hashes, shapes], 1)[codes] % np.uint64(CELLS)
    return np.repeat(owner, 2), both.reshape(-1).astype(np.int64)


def labelled(labels: DataFrame, domain: Column, domains: list[str]) -> DataFrame:
    """``doc_id``, ``d`` (position of the domain) and ``fold`` of usable labels; of several for one id, the last domain counts."""
    position = F.array_position(F.array(*map(F.lit, domains)), domain) - 1
    rows = labels.select("doc_id", position.cast("int").alias("d")).where("doc_id IS NOT NULL AND d >= 0")
    return rows.groupBy("doc_id").agg(F.max("d").alias("d")).select("doc_id", "d", F.pmod(crc_of_id(F.col("doc_id")), F.lit(2)).alias("fold"))


class Classifier:
    """Log-probabilities of the cells by domain, and the regression on their means."""

    def __init__(self, logs: np.ndarray, weights: np.ndarray | None = None) -> None:
        self.logs, self.weights = logs, weights

    def means(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        owner, cells = tokens(texts)
        count = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, log[cells], minlength=len(texts)) for log in self.logs], 1)
        return sums / np.maximum(count, 1)[:, None], count // 2

    def features(self, means: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Differences to the mean over domains, twice: as they are, and weighed down in short texts."""
        centred = means - means.mean(1, keepdims=True)
        held = centred * (count / (count + 50.0))[:, None]
        return np.concatenate([np.ones((len(means), 1)), 10 * centred, 10 * held], 1)

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        means, count = self.means(texts)
        return count, _softmax(self.features(means, count) @ self.weights)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _regress(x: np.ndarray, y: np.ndarray, classes: int, ridge: float = 0.05, rounds: int = 400) -> np.ndarray:
    """Weights of a multinomial logistic regression, by accelerated gradient steps."""
    scale = x.std(0)
    scale[scale == 0] = 1.0
    z = x / scale
    target = np.eye(classes)[y]
    step = 1 / (0.5 * np.linalg.norm(z, 2) ** 2 / len(z) + ridge / len(z) + 1e-9)
    beta = ahead = np.zeros((x.shape[1], classes))
    for at in range(rounds):
        slope = z.T @ (_softmax(z @ ahead) - target) / len(z) + ridge / len(z) * ahead
        new = ahead - step * slope
        ahead, beta = new + at / (at + 3) * (new - beta), new
    return beta / scale[:, None]


def fit_classifier(docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], max_calibration: int = 6_000) -> Classifier:
    """``domain`` is an expression over ``labels``. All labelled texts are counted; the regression sees at most
    ``max_calibration`` of them, drawn by a hash of their ids."""
    rows = labelled(labels, domain, domains)
    counting = rows.where("fold = 0")
    found = docs.select("doc_id", "text").join(counting.hint("merge"), "doc_id").select("d", "text")  # one plan at every size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(domains) * CELLS, np.int64)
        for batch in batches:
            for start, part in w.chunks(batch.column("text")):
                of = batch.column("d").slice(start, len(part)).to_numpy(zero_copy_only=False).astype(np.int64)
                owner, cells = tokens(part)
                total += np.bincount(of[owner] * CELLS + cells, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    counts = found.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # domains x CELLS
    table = np.zeros(len(domains) * CELLS)
    table[counts["at"].to_numpy()] = counts["n"].to_numpy()
    table = table.reshape(len(domains), CELLS)
    # Smoothed towards the cells' shares over all domains.
    overall = (table.sum(0) + 0.1) / (table.sum() + 0.1 * CELLS)
    logs = np.log((table + 2000 * overall) / (table.sum(1, keepdims=True) + 2000))
    classifier = Classifier(logs)
    chosen = settle(rows.where("fold = 1").orderBy(F.xxhash64("doc_id")).limit(max_calibration).select("doc_id", "d"))
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in w.chunks(batch.column("text")):
                found, n = shared.value.means(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d").slice(start, len(part)), pa.array(n, pa.int64()), pa.array(list(found), pa.list_(pa.float64()))],
                    names=["d", "n", "means"],
                )

    seen = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("d", "text")
    seen = seen.mapInArrow(means, "d int, n long, means array<double>").toPandas()  # about max_calibration short rows
    if len(seen):
        x = classifier.features(np.stack(seen["means"].to_numpy()), seen["n"].to_numpy())
        classifier.weights = _regress(x, seen["d"].to_numpy(), len(domains))
    else:
        classifier.weights = np.zeros((1 + 2 * len(domains), len(domains)))
    return classifier


def posterior_column(docs: DataFrame, classifier: Classifier) -> Column:
    """Struct of ``n_words`` and ``posterior`` (one number per domain) of the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.arrow_udf(_SHAPE)
    def predict(texts: pa.Array) -> pa.Array:
        count, found = [np.zeros(0, np.int64)], [np.zeros((0, len(classifier.logs)))]
        for _, part in w.chunks(texts):
            n, p = shared.value.posteriors(part)
            count.append(n)
            found.append(p)
        count, found = np.concatenate(count), np.concatenate(found)
        flat = pa.array(found.reshape(-1), pa.float64())
        ends = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
        return pa.StructArray.from_arrays([pa.array(count, pa.int64()), pa.ListArray.from_arrays(ends, flat)], ["n_words", "posterior"])

    return predict(F.col("text"))


def _step(rate: Column, posterior: Column, slope: list[float], most: float | None) -> Column:
    pull = sum((F.get(posterior, F.lit(d)) * F.lit(float(g)) for d, g in enumerate(slope)), F.lit(0.0))
    new = F.greatest(rate - pull, F.lit(0.0))
    return F.least(new, F.lit(float(most))) if most is not None else new


def solve_rates(
    known: DataFrame, domains: list[str], weights: dict[str, float], budget: float | None = None, max_rate: float | None = None,
    rounds: int = 60, tolerance: float = 1e-4, block: int = 12,
) -> tuple[list[list[float]], dict[str, list[float]]]:
    """The slopes of all rounds, from which every document's rate follows, and the domains' natural, target and final totals.

    Ends when all totals meet their targets, or a round moves none of them, within ``tolerance`` of the budget.

    ``known`` has ``n_words`` and ``posterior``. ``budget``: total tokens wanted; None means so many that the
    domain of the largest weight is used as much as it is there.
    """
    total = [F.coalesce(F.sum(F.col("n_words") * F.get("posterior", F.lit(d))), F.lit(0.0)).alias(f"s{d}") for d in range(len(domains))]
    natural = np.array(list(known.agg(*total).head()), float)
    share = np.array([weights[name] for name in domains], float)
    share = share / share.sum()
    if budget is None:
        budget = natural[share.argmax()] / share.max()
    target = budget * share
    if natural.sum() == 0:
        return [], {name: [0.0, 0.0, 0.0] for name in domains}
    scale = np.maximum(natural, natural.sum() * 1e-9)
    slopes: list[list[float]] = []
    state, rate, since = known.withColumn("rate", F.lit(1.0)), F.col("rate"), 0
    reached = natural
    for _ in range(rounds):
        residual = reached - target
        if np.abs(residual).max() <= tolerance * max(budget, 1.0):
            break
        slope = (residual / scale).tolist()
        slopes.append(slope)
        rate, since = _step(rate, F.col("posterior"), slope, max_rate), since + 1
        if since == block:  # so that the expression does not grow
            state, rate, since = settle(state.withColumn("rate", rate)), F.col("rate"), 0
        use = F.col("n_words") * rate
        sums = [F.coalesce(F.sum(use * F.get("posterior", F.lit(d))), F.lit(0.0)).alias(f"s{d}") for d in range(len(domains))]
        before, reached = reached, np.array(list(state.agg(*sums).head()), float)
        if np.abs(reached - before).max() < tolerance * budget:
            break
    return slopes, {name: [natural[d], target[d], reached[d]] for d, name in enumerate(domains)}


def rate_column(posterior: Column, n_words: Column, slopes: list[list[float]], max_rate: float | None) -> Column:
    """The rate of a document, by running through all rounds."""
    if not slopes:
        return F.lit(1.0)
    steps = F.array(*(F.array(*(F.lit(float(g)) for g in slope)) for slope in slopes))

    def after(rate: Column, slope: Column) -> Column:
        pull = F.aggregate(F.zip_with(posterior, slope, lambda p, g: p * g), F.lit(0.0), lambda a, b: a + b)
        new = F.greatest(rate - pull, F.lit(0.0))
        return F.least(new, F.lit(float(max_rate))) if max_rate is not None else new

    return F.when(n_words == 0, F.lit(1.0)).otherwise(F.aggregate(steps, F.lit(1.0), after))


def _copies(rate: Column, *keys: str) -> Column:
    """A whole number of uses whose mean is the rate, drawn by a hash of the row."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(11), *keys), 11) / float(2**53)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def fit_rates(
    docs: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float], budget: float | None = None,
    max_rate: float | None = None,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``posterior`` (map by domain), ``rate`` and ``copies`` (a whole draw of the rate)."""
    domains = list(weights)
    with arrow_batches(docs.sparkSession, SMALL_BATCH):
        classifier = fit_classifier(docs, labels, domain, domains)
        known = settle(docs.select("doc_id", posterior_column(docs, classifier).alias("c")).select("doc_id", "c.n_words", "c.posterior"))
    slopes, _ = solve_rates(known, domains, weights, budget, max_rate)
    rate = rate_column(F.col("posterior"), F.col("n_words"), slopes, max_rate)
    rated = known.withColumn("rate", rate)
    names = F.array(*map(F.lit, domains))
    return rated.select(
        "doc_id", "n_words", F.map_from_arrays(names, "posterior").alias("posterior"), "rate", _copies(F.col("rate"), "doc_id").alias("copies")
    )


def mix_documents(
    docs: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float], budget: float | None = None,
    max_rate: float | None = None,
) -> DataFrame:
    """``docs`` with each row as often as its rate says (a row of the rate 0.3 stays with probability 0.3)."""
    domains = list(weights)
    c, n = fresh(docs, "_c"), fresh(docs, "_n")
    with arrow_batches(docs.sparkSession, SMALL_BATCH):
        classifier = fit_classifier(docs, labels, domain, domains)
        # Written with the documents: the posteriors are found once, and in small batches, whoever reads the result.
        known = settle(docs.withColumn(c, posterior_column(docs, classifier)))
    slopes, _ = solve_rates(known.select(F.col(c)["n_words"].alias("n_words"), F.col(c)["posterior"].alias("posterior")), domains, weights, budget, max_rate)
    rate = rate_column(F.col(c)["posterior"], F.col(c)["n_words"], slopes, max_rate)
    out = known.withColumn(n, _copies(rate, "doc_id")).where(F.col(n) > 0)
    again = fresh(out, "_again")
    out = out.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(n)))) if max_rate is None or max_rate > 1 else out
    return out.select(*(F.col(f"`{name}`") for name in docs.columns))
