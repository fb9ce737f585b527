"""A log-bilinear language model, trained with noise-contrastive estimation, and the scores of texts under it.

Tokens are words and one end per text. The model speaks of *symbols*: the most frequent tokens, and for all others the class that the
last two bytes of the word belong to. It predicts a vector from the two symbols before, by one matrix for each of their places, and a
symbol's score is the product of its own vector with that prediction plus its bias. A word of a class then takes its share by
smoothed counts of all training texts, so the probabilities of all words and of one event for every unknown word sum to one in every context.

* **Counts** of all words come from all training texts. Frequent words, a table of bounded size, are looked up by the tasks; counts of all
  others are joined to the texts that hold them.
* **Training** goes through all training texts. Each task starts from the same parameters, goes through its texts batch by batch with noise
  drawn from the symbols' frequencies, and gives its parameters, which Spark averages by the number of their tokens. With several rounds
  each has its share of the texts, so every text is learnt from once. At most ``trainers`` tasks train, so what is averaged is bounded.
* **Scores** are normalised: the distinct contexts of a chunk are multiplied with all symbols, block by block.

* A null or empty text is the end alone. A null ``doc_id`` counts as an empty text in the fold. Texts of any length are read whole.
* Repeated rows are learnt from and scored each. Ties of frequency in the choice of symbols go to the smaller word in byte order.
* Without training texts all counts are 0 and every symbol is as likely as another. An empty table gives no rows.
* Columns other than ``doc_id`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.llm import words as w
from tidelight.llm.grams import byte_classes, cut_words, pieces_of_texts
from tidelight.llm.tables import crc_of_id
from tidelight.session import settle

CHUNK = 2 << 20
WHITE = byte_classes(b" \t\n\x0b\x0c\r")
END = ""  # no word is empty
FOLDS, HELD_OUT = 7, 2
ORDER = 2


@dataclass(frozen=True)
class Settings:
    """Sizes of the model and of its training."""

    symbols: int = 512  # tokens that are symbols of their own
    classes: int = 64  # of all other words
    dims: int = 24
    noise: int = 32
    batch: int = 1024
    rate: float = 0.05
    rounds: int = 2
    trainers: int = 256
    looked_up: int = 1 << 18  # words whose counts the tasks hold

    @property
    def all_symbols(self) -> int:
        return self.symbols + self.classes


def held_out(doc_id: Column) -> Column:
    return F.pmod(crc_of_id(doc_id), F.lit(FOLDS)) == HELD_OUT


def ending_class(words: pa.Array, classes: int) -> np.ndarray:
    """A class by the last two bytes of each word."""
    words = pa.concat_arrays([words.cast(pa.large_string())])
    if not len(words):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
    data = np.append(np.zeros(2, np.uint8), np.frombuffer(words.buffers()[2] or b"", np.uint8)).astype(np.int64)
    ends, sizes = offsets[1:] + 1, np.diff(offsets)
    last, before = np.where(sizes > 0, data[ends], 0), np.where(sizes > 1, data[ends - 1], 0)
    return (w.mix((before * 256 + last).astype(np.uint64)) % np.uint64(classes)).astype(np.int64)


def token_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of every token of the training texts; the end is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in pieces_of_texts(batches, "text", CHUNK):
            words = cut_words(part, WHITE)
            found = [words.distinct.cast(pa.string()), pa.array([END], pa.string())]
            counts = np.append(np.bincount(words.code, minlength=len(words.distinct)), len(part))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(found), pa.array(counts.astype(np.int64))], names=["word", "n"])

    return docs.where(~held_out(F.col("doc_id"))).select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    )


@dataclass
class Vocabulary:
    """The looked-up words by falling count, and what is known of all."""

    words: pa.Array
    counts: np.ndarray
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray
    settings: Settings

    @property
    def end(self) -> int:
        return self.settings.symbols - 1

    def noise(self) -> np.ndarray:
        """The share of each symbol among the training tokens, smoothed."""
        own = np.zeros(self.settings.symbols)
        top = self.words[: self.end].to_pylist()
        own[: len(top)] = self.counts[: len(top)]
        own[self.end] = max(0, self.tokens - own.sum() - self.class_tokens.sum())
        shares = np.append(own, self.class_tokens) + 1.0
        return shares / shares.sum()


def _most_frequent(words: DataFrame, most: int) -> pa.Table:
    """The words of the highest counts, in order: as many whole eighths of powers of two as hold at most ``most`` words."""
    level = F.floor(F.log2("n") * 8)
    levels = words.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()  # at most 8 * 63 rows
    taken, least = 0, None
    for row in sorted(levels, key=lambda row: -row.level):
        if taken + row.words > most:
            break
        taken, least = taken + row.words, row.level
    found = words.where(level >= least) if least is not None else words.limit(0)
    return found.select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])


def vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    """From a settled table of :func:`token_counts`. The end is the last of the symbols with a vector of their own."""
    words = counts.where(F.col("word") != END)
    top = _most_frequent(words, settings.looked_up)
    edge = top.slice(max(0, min(settings.symbols - 1, top.num_rows) - 1), 1).to_pylist()  # the last with a vector of its own

    @F.arrow_udf("int")
    def class_of(found: pa.Array) -> pa.Array:
        return pa.array(ending_class(found, settings.classes).astype(np.int32))

    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).head()
    per_class = np.zeros((2, settings.classes), np.int64)
    rest = words
    if edge:
        n, word = edge[0]["n"], edge[0]["word"]
        rest = words.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
    for row in rest.groupBy(class_of("word").alias("at")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        per_class[:, row["at"]] = row.n, row.v
    held = pa.concat_arrays([c.cast(pa.large_string()) for c in top.column("word").chunks] or [pa.array([], pa.large_string())])
    return Vocabulary(held, top.column("n").to_numpy(), totals.n, totals.v, *per_class, settings)


_ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, known long, looked_up double, looked_up_rest double, rest_norm double, "
    "symbols binary, rare array<struct<word:string,n:int>>"
)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Each text as symbols (16-bit numbers), with the sums of log10(count + 1) over its looked-up words, and its other words."""
    settings = vocab.settings
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        logs = np.append(np.log10(v.counts + 1.0), 0.0)
        norms = np.log10(v.class_tokens + v.class_distinct + 1.0)
        for batch, part in pieces_of_texts(batches, "text", CHUNK):
            rows = len(part)
            words = cut_words(part, WHITE)
            at = pc.fill_null(pc.index_in(words.distinct, value_set=v.words), len(v.words)).to_numpy(zero_copy_only=False).astype(np.int64)
            kind = np.where(at < min(v.end, len(v.words)), at, settings.symbols + ending_class(words.distinct, settings.classes))
            code, owner = words.code, words.owner
            place, symbol = at[code], kind[code]
            rest, known = symbol >= settings.symbols, place < len(v.words)
            value = logs[place]
            sums = [np.bincount(owner, weights, minlength=rows) for weights in (value, value * rest)]
            norm = np.bincount(owner[rest], norms[symbol[rest] - settings.symbols], minlength=rows)
            count = np.bincount(owner, minlength=rows)
            # Texts with their ends: one more place per text before.
            filled = np.full(len(words) + rows, v.end, np.int16)
            filled[np.arange(len(words)) + owner] = symbol
            bounds = np.append(0, np.cumsum(count + 1))
            blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(bounds * 2), pa.py_buffer(filled)])
            keys, times = np.unique(owner[~known] * (len(words.distinct) + 1) + code[~known], return_counts=True)
            holder, found = keys // (len(words.distinct) + 1), keys % (len(words.distinct) + 1)
            rare = pa.StructArray.from_arrays(
                [words.distinct.take(pa.array(found)).cast(pa.string()), pa.array(times.astype(np.int32))], ["word", "n"]
            )
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(holder, minlength=rows))).astype(np.int32)), rare)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(count + 1),
                 pa.array(np.bincount(owner[known], minlength=rows)), *(pa.array(x, pa.float64()) for x in (*sums, norm)),
                 blob.cast(pa.binary()), lists],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "looked_up", "looked_up_rest", "rest_norm", "symbols", "rare"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return rows.mapInArrow(measure, _ENCODED)


def contexts_of(symbols: list[bytes], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all texts in a row, the two before each (``start`` where there is none), and the text of each."""
    sizes = np.array([len(s) // 2 for s in symbols], np.int64)
    flat = np.frombuffer(b"".join(symbols), np.int16).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    context = np.full((len(flat), ORDER), start, np.int64)
    for back in range(1, ORDER + 1):
        inside = owner[back:] == owner[:-back]
        context[back:, back - 1][inside] = flat[:-back][inside]
    return flat, context, owner


class Bilinear:
    """Parameters: vectors of contexts (one more for the start) and of targets, biases, a matrix for each place."""

    def __init__(self, symbols: int, dims: int, bias: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.context = rng.normal(0, 0.1, (symbols + 1, dims)).astype(np.float32)
        self.target = rng.normal(0, 0.1, (symbols, dims)).astype(np.float32)
        self.bias = bias.astype(np.float32)
        self.places = np.repeat(np.eye(dims, dtype=np.float32)[None], ORDER, 0)

    def _parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.bias, self.places]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self._parts()])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for part in self._parts():
            part[...] = values[at : at + part.size].reshape(part.shape)
            at += part.size

    def predict(self, context: np.ndarray) -> np.ndarray:
        """The predicted vector of each context."""
        return sum(self.context[context[:, j]] @ self.places[j] for j in range(ORDER))

    def log_probabilities(self, context: np.ndarray, symbol: np.ndarray, block: int = 4096) -> np.ndarray:
        """Natural logarithms of the normalised probabilities; each distinct context is multiplied with all symbols once."""
        size = len(self.context)
        keys = context @ (size ** np.arange(ORDER))
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else order
        ends = np.append(first[1:], len(order))
        out = np.empty(len(order))
        for at in range(0, len(first), block):
            heads, stop = first[at : at + block], ends[min(at + block, len(first)) - 1]
            scores = self.predict(context[order[heads]]) @ self.target.T + self.bias
            top = scores.max(1)
            total = np.log(np.exp(scores - top[:, None]).sum(1, dtype=np.float64)) + top
            members = order[heads[0] : stop]
            which = np.repeat(np.arange(len(heads)), ends[at : at + block] - heads)
            out[members] = scores[which, symbol[members]] - total[which]
        return out


def _add_rows(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Add each row of ``values`` to the row of ``out`` that ``at`` names."""
    order = np.argsort(at, kind="stable")
    ordered = at[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    out[ordered[first]] += np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Noise-contrastive estimation in batches, with steps that shrink by the squares of past slopes."""

    def __init__(self, model: Bilinear, shares: np.ndarray, settings: Settings, seed: int) -> None:
        self.model, self.settings = model, settings
        self.rng = np.random.default_rng(seed)
        self.cumulated = np.cumsum(shares)
        self.log_noise = np.log(settings.noise * shares).astype(np.float32)
        self.squares = [np.full(p.shape, 1e-6, np.float32) for p in model._parts()]

    def step(self, context: np.ndarray, symbol: np.ndarray) -> None:
        """One step uphill on the logarithm of telling each true symbol from noise that the batch shares."""
        m = self.model
        drawn = np.minimum(np.searchsorted(self.cumulated, self.rng.random(self.settings.noise)), len(m.bias) - 1)
        held = [m.context[context[:, j]] for j in range(ORDER)]
        guess = sum(h @ m.places[j] for j, h in enumerate(held))
        true, noise = m.target[symbol], m.target[drawn]
        right = np.einsum("nd,nd->n", guess, true) + m.bias[symbol] - self.log_noise[symbol]
        wrong = guess @ noise.T + (m.bias[drawn] - self.log_noise[drawn])
        up = 1 / (1 + np.exp(np.minimum(right, 30)))
        down = -1 / (1 + np.exp(np.minimum(-wrong, 30)))
        slopes = [np.zeros_like(p) for p in m._parts()]
        _add_rows(slopes[1], symbol, up[:, None] * guess)
        np.add.at(slopes[1], drawn, down.T @ guess)
        slopes[2] += np.bincount(symbol, up, minlength=len(m.bias)).astype(np.float32)
        np.add.at(slopes[2], drawn, down.sum(0))
        back = up[:, None] * true + down @ noise
        for j, h in enumerate(held):
            slopes[3][j] = h.T @ back
            _add_rows(slopes[0], context[:, j], back @ m.places[j].T)
        for part, slope, square in zip(m._parts(), slopes, self.squares):
            slope /= len(symbol)
            square += slope * slope
            part += self.settings.rate * slope / np.sqrt(square)

    def learn(self, context: np.ndarray, symbol: np.ndarray) -> None:
        for at in range(0, len(symbol), self.settings.batch):
            self.step(context[at : at + self.settings.batch], symbol[at : at + self.settings.batch])


def train(encoded: DataFrame, vocab: Vocabulary) -> Bilinear:
    """Averages of the parameters that tasks learn from all rows of ``encoded`` (settled) that are not held out."""
    settings, context = vocab.settings, encoded.sparkSession.sparkContext
    shares = vocab.noise()
    model = Bilinear(settings.all_symbols, settings.dims, np.log(shares))
    rows = encoded.where("NOT held_out").select("row", "symbols").coalesce(settings.trainers)
    for round_no in range(settings.rounds):
        shared = context.broadcast((model, shares))

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, round_no=round_no) -> Iterator[pa.RecordBatch]:
            begun, noise = shared.value
            own = Bilinear(settings.all_symbols, settings.dims, begun.bias)
            own.load(begun.flat())
            trainer, seen = Trainer(own, noise, settings, round_no), 0
            for batch in batches:
                for _, part in w.chunks(batch.column("symbols"), CHUNK // 4):
                    symbol, before, _ = contexts_of(part.to_pylist(), settings.all_symbols)
                    trainer.learn(before, symbol)
                    seen += len(symbol)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([own.flat().tolist()], pa.list_(pa.float32()))], names=["seen", "flat"])

        part = rows.where(F.pmod(F.xxhash64("row"), F.lit(settings.rounds)) == round_no).select("symbols")
        learnt = part.mapInArrow(learn, "seen long, flat array<float>")
        each = learnt.select("seen", F.posexplode("flat").alias("at", "value"))
        mean = each.groupBy("at").agg((F.sum(F.col("value") * F.col("seen")) / F.sum("seen")).alias("value")).toArrow()
        if mean.num_rows:
            values = np.empty(mean.num_rows, np.float32)
            values[mean.column("at").to_numpy()] = mean.column("value").to_numpy()
            model.load(values)
    return model


def score(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``base_score`` is the log10 probability by counts with one added; ``score`` is that of the model.
    """
    counts = settle(token_counts(docs))
    vocab = vocabulary(counts, settings)
    encoded = settle(encode(docs, vocab))
    shared = docs.sparkSession.sparkContext.broadcast(train(encoded, vocab))

    @F.arrow_udf("double")
    def modelled(symbols: pa.Array) -> pa.Array:
        out = []
        for _, part in w.chunks(symbols, CHUNK // 2):
            symbol, context, owner = contexts_of(part.to_pylist(), settings.all_symbols)
            out.append(np.bincount(owner, shared.value.log_probabilities(context, symbol), minlength=len(part)) / np.log(10))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    found = rare.join(counts, "word").groupBy(F.col("row").alias("_row")).agg(
        F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("_log")
    )
    scored = encoded.select("*", modelled("symbols").alias("_model")).drop("symbols", "rare")
    joined = scored.join(found, F.col("row") == F.col("_row"), "left").na.fill(0, ["_known", "_log"])
    ends = counts.where(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head().n
    width = F.lit(float(np.log10(vocab.tokens + vocab.distinct + 1)))
    base = F.col("looked_up") + F.col("_log") + F.lit(float(np.log10(ends + 1.0))) - F.col("n_tokens") * width
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("_known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("_model") + F.col("looked_up_rest") + F.col("_log") - F.col("rest_norm")).alias("score"),
    )
