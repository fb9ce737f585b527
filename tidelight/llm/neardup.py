"""Near-duplicate documents by improved consistent weighted sampling.

A text is a set of shingles of five words, each weighing its frequency in the text times 1 plus ``IDF_GAIN`` times the
relative inverse document frequency of its cell. (Shingles are hashed to ``IDF_CELLS`` cells, so the table of weights has a
fixed size; cells are counted over all documents. The gain is below 1 because the shingles that many near copies share
are frequent for that reason: with undamped weights the few edited ones would outweigh them.) Consistent weighted sampling draws ``bands`` x ``rows`` samples that agree between two texts with
the probability of their weighted Jaccard similarity. Texts that agree in a band are candidates, and those whose
weighted Jaccard similarity is at least the threshold are linked. Classes are the connected components.

Equal texts are put together first and count once. In a bucket of candidates every text is compared with one pivot. Buckets
that hold several classes afterwards are dealt out in blocks of about ``BLOCK`` texts, and every two blocks make a tile whose texts of
different classes are compared side by side, so a text travels once a tile and not once a pair. Texts of large classes have blocks
of their own, which make no tiles among themselves. Nothing is left out.

* Words are taken in lower case, without marks around them. A text of fewer than five words is one shingle; texts without words are
  alike. A null text is an empty text. A row without ``doc_id`` goes by a negative number made of its text.
* Ties: the smallest ``doc_id`` names a class. Repeated rows are equal texts. Different texts under one ``doc_id`` count as
  one document, compared by one of these texts. An empty table gives no rows.
* Other columns are not read by :func:`near_duplicates`; in :func:`keep_first` they pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.llm import words as w
from tidelight.llm.components import components
from tidelight.llm.tables import fresh
from tidelight.session import settle

SHINGLE = 5
IDF_CELLS = 1 << 18
IDF_GAIN = 0.5
BLOCK = 128  # texts of a block, on average at most
BLOCK_BYTES = 1 << 20  # and their bytes
_BITS = np.uint64(44)  # of a shingle's hash that are kept
_OUTER = ".,;:!?\"'()[]{}*#$%&|<>…"


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash (44 bits) and count of the distinct shingles of each text, by row and hash."""
    rows = len(texts)
    owner, found = w.split_words(pc.utf8_lower(w.whole(texts)))
    bare = pc.utf8_trim(found, characters=_OUTER)
    codes, distinct = w.encode(bare)
    filled = pc.not_equal(bare, "").to_numpy(zero_copy_only=False)
    owner, hashes = owner[filled], w.hash_strings(distinct)[codes[filled]] if len(distinct) else np.zeros(0, np.uint64)
    first, total = w.windows(owner, hashes, SHINGLE)
    of = owner[first]
    count = w.per_text(owner, None, rows)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        starts = np.searchsorted(owner, short)
        whole = np.zeros(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for at in range(SHINGLE - 1):
                more = at < count[short]
                whole[more] = w.mix(whole[more] * np.uint64(31) + hashes[starts[more] + at] + np.uint64(1))
        of, total = np.concatenate([of, short]), np.concatenate([total, whole])
    packed = np.sort(of.astype(np.uint64) << _BITS | total >> np.uint64(20))
    if not len(packed):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    counts = np.diff(np.append(new, len(packed)))
    packed = packed[new]
    return (packed >> _BITS).astype(np.int64), packed & ((np.uint64(1) << _BITS) - np.uint64(1)), counts


def own_id() -> Column:
    """``doc_id``, or a negative number made of the text."""
    return F.coalesce(F.col("doc_id").cast("long"), -1 - F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1))


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(IDF_CELLS)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """1 + IDF_GAIN ln((1 + documents) / (1 + documents with the cell)) / ln(1 + documents) of every cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(IDF_CELLS, np.int64), 0
        for batch in batches:
            for _, part in w.chunks(batch.column("text")):
                owner, hashes, _ = shingles(part)
                seen = np.unique(owner * IDF_CELLS + _cell(hashes))
                total += np.bincount(seen % IDF_CELLS, minlength=IDF_CELLS)
                documents += len(part)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], documents))], names=["cell", "n"]
        )

    counts = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(IDF_CELLS + 1)
    frequency[counts.cell.to_numpy()] = counts.n.to_numpy()
    every = max(1.0, frequency[-1])
    return 1 + IDF_GAIN * np.log((1 + every) / (1 + frequency[:-1])) / np.log(1 + every)


# Quantiles of the Gamma(2, 1) distribution and of its logarithm, from the series of its distribution function.
_GRID = 1 << 16


def _gamma_table() -> np.ndarray:
    x = np.concatenate([[0.0], np.geomspace(1e-5, 40, 400_000)])
    return np.interp((np.arange(_GRID) + 0.5) / _GRID, 1 - (1 + x) * np.exp(-x), x)


_GAMMA = _gamma_table().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_INVERSE_GAMMA = 1 / _GAMMA


def samples(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and ``count`` consistent weighted samples (64 bits) of each.

    For every shingle and sample: r and c of Gamma(2, 1), b uniform, all drawn from the hash; t = floor(ln S / r + b);
    the shingle of the smallest ln c - r (t - b + 1) is the sample, together with its t.
    """
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    rows = owner[starts]
    out = np.zeros((len(rows), count), np.uint64)
    logs = np.log(weights).astype(np.float32)
    places = np.arange(len(hashes), dtype=np.uint64)
    for k in range(count):
        with np.errstate(over="ignore"):
            drawn = w.mix(hashes + np.uint64(k + 1) * np.uint64(0xA0761D6478BD642F))
        r_at = (drawn & np.uint64(_GRID - 1)).astype(np.int64)
        b = (drawn >> np.uint64(48)).astype(np.float32) / np.float32(_GRID)
        t = np.floor(logs * _INVERSE_GAMMA[r_at] + b)
        key = _LOG_GAMMA[(drawn >> np.uint64(16) & np.uint64(_GRID - 1)).astype(np.int64)] - _GAMMA[r_at] * (t - b + 1)
        bits = key.astype(np.float32).view(np.uint32)
        ordered = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        if len(starts):
            best = np.minimum.reduceat(ordered << np.uint64(32) | places, starts) & np.uint64(0xFFFFFFFF)
            best = best.astype(np.int64)
            with np.errstate(over="ignore"):
                out[:, k] = w.mix(hashes[best] * np.uint64(0xE7037ED1A0B428DB) + t[best].astype(np.int64).view(np.uint64))
    return rows, out


def signatures(docs: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``own`` (never null), 128 bits of the text ``t1``, ``t2``, and one 64-bit column per band; bands of texts without words are null."""

    @F.arrow_udf("struct<" + ",".join(f"b{at}:long" for at in range(bands)) + ">")
    def band_keys(texts: pa.Array) -> pa.Array:
        keys, filled = np.zeros((len(texts), bands), np.int64), np.zeros(len(texts), bool)
        for start, part in w.chunks(texts):
            owner, hashes, counts = shingles(part)
            found, drawn = samples(owner, hashes, counts * idf.value[_cell(hashes)], bands * rows)
            filled[start + found] = True
            for band in range(bands):
                key = np.full(len(found), band, np.uint64)
                with np.errstate(over="ignore"):
                    for at in range(rows):
                        key = w.mix(key * np.uint64(31) + drawn[:, band * rows + at])
                keys[start + found, band] = key.view(np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(keys[:, at], pa.int64(), mask=~filled) for at in range(bands)], [f"b{at}" for at in range(bands)]
        )

    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", own_id().alias("own"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"),
        band_keys("text").alias("s"),
    ).select("doc_id", "own", "t1", "t2", "s.*")


def _weighed(texts: pa.Array, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes and weights of the shingles of each text."""
    out = []
    for _, part in w.chunks(texts):
        owner, hashes, counts = shingles(part)
        weights = counts * idf[_cell(hashes)]
        ends = np.searchsorted(owner, np.arange(len(part) + 1)).tolist()
        out += [(hashes[a:b], weights[a:b]) for a, b in zip(ends, ends[1:])]
    return out


def _similar(idf, threshold: float):
    """Pairs with both texts, sorted by ``a``, to those whose weighted Jaccard similarity reaches the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, weighed = None, None
        for whole in batches:
            for start, texts in w.chunks(whole.column("tb")):
                batch = whole.slice(start, len(texts))
                kept, values = [], []
                for at, (a, other) in enumerate(zip(batch.column("a").to_pylist(), _weighed(texts, idf.value))):
                    if a != last:
                        last, weighed = a, _weigh(batch.column("ta").slice(at, 1), idf.value)
                    value = weighted_jaccard(weighed, other)
                    if value >= threshold:
                        kept.append(at)
                        values.append(value)
                out = batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(values, pa.float64())], names=["a", "b", "similarity"])

    return verify


def tile_links(
    weighed: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, comparable, threshold: float
) -> list[tuple[int, int, float]]:
    """Places and similarity of similar texts of different classes, until those that are similar are in one class.

    ``comparable(i, j)`` tells which of the places ``j`` are to be compared with ``i``.
    """
    count = len(weighed)
    ends = np.cumsum([len(hashes) for hashes, _ in weighed])
    starts = np.append(0, ends[:-1])
    weights = np.concatenate([part for _, part in weighed])
    distinct, cell = np.unique(np.concatenate([hashes for hashes, _ in weighed]), return_inverse=True)
    totals = np.array([part.sum() for _, part in weighed])
    owner = np.repeat(np.arange(count), ends - starts)
    label, mine, found = classes.copy(), np.zeros(len(distinct)), []
    for i in range(count - 1):
        others = np.arange(i + 1, count)
        # What two texts share is at most the lighter one.
        near = np.minimum(totals[others], totals[i]) >= (threshold - 1e-9) * np.maximum(totals[others], totals[i])
        others = others[near & (label[others] != label[i])]
        others = others[comparable(i, others)] if len(others) else others
        if not len(others):
            continue
        mine[cell[starts[i] : ends[i]]] = weights[starts[i] : ends[i]]
        if 4 * len(others) > count:
            rest = slice(starts[i + 1], None)
            shared = np.bincount(owner[rest], np.minimum(mine[cell[rest]], weights[rest]), minlength=count)[others]
        else:
            shared = np.array([np.minimum(mine[cell[starts[j] : ends[j]]], weights[starts[j] : ends[j]]).sum() for j in others])
        mine[cell[starts[i] : ends[i]]] = 0.0
        for j in others[shared >= (threshold - 1e-9) * (totals[i] + totals[others] - shared)].tolist():
            value = weighted_jaccard(weighed[i], weighed[j])
            if value >= threshold:
                found.append((i, j, value))
                label[label == label[j]] = label[i]
    return found


def _similar_in_tiles(idf, threshold: float):
    """The links of each tile (``band``, ``whole``, ``members``)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, (band, whole) in enumerate(zip(batch.column("band").to_pylist(), batch.column("whole").to_pylist())):
                members = pa.concat_arrays([batch.column("members").slice(at, 1).flatten()])
                reps = members.field("rep").to_numpy()
                order = np.argsort(reps)
                members, reps = members.take(pa.array(order)), reps[order]
                side = members.field("side").to_numpy(zero_copy_only=False)
                keys = members.field("keys").flatten().to_numpy().reshape(len(reps), -1)[:, :band]

                def comparable(i: int, j: np.ndarray) -> np.ndarray:
                    # Texts that share the bucket of an earlier band are compared there, or were found in one class.
                    return (whole | (side[j] != side[i])) & ~(keys[j] == keys[i]).any(1)

                weighed = _weighed(members.field("text"), idf.value)
                for i, j, value in tile_links(weighed, members.field("class_id").to_numpy(), comparable, threshold):
                    rows.append((int(reps[i]), int(reps[j]), value))
            if rows:
                columns = zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=["a", "b", "similarity"])

    return link


def _weigh(text: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, hashes, counts = shingles(text)
    return hashes, counts * idf[_cell(hashes)]


def weighted_jaccard(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> float:
    _, mine, yours = np.intersect1d(first[0], second[0], assume_unique=True, return_indices=True)
    shared = np.minimum(first[1][mine], second[1][yours]).sum()
    union = first[1].sum() + second[1].sum() - shared
    return float(shared / union) if union else 1.0


def link_texts(docs: DataFrame, threshold: float = 0.8, bands: int = 12, rows: int = 4):
    """(documents with ``t1``, ``t2``; representatives ``rep``, ``t1``, ``t2``, ``class_id``; links ``a``, ``b``, ``similarity``).

    With 12 bands of 4 samples, texts of similarity 0.8 become candidates with probability 0.998, of 0.9 with 0.99999.
    """
    idf = docs.sparkSession.sparkContext.broadcast(inverse_frequencies(docs))  # IDF_CELLS numbers
    signed = settle(signatures(docs, idf, bands, rows))
    names = [f"b{at}" for at in range(bands)]
    texts = settle(signed.groupBy("t1", "t2").agg(F.min("own").alias("rep"), *(F.max(b).alias(b) for b in names)))
    unpivoted = texts.where("b0 IS NOT NULL").select(
        "rep", F.stack(F.lit(bands), *(part for at, b in enumerate(names) for part in (F.lit(at), F.col(b)))).alias("band", "key")
    )
    shared = unpivoted.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("rep").alias("pivot")).where("n > 1")
    pivots = settle(shared.select("band", "key", "pivot"))
    held = settle(unpivoted.join(pivots.hint("merge"), ["band", "key"]))
    pairs = settle(held.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    candidates = settle(
        docs.select(own_id().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(wanted.hint("merge"), "doc_id", "left_semi")
        .dropDuplicates(["doc_id"])
    )
    links = settle(_verified(pairs, candidates, idf, threshold))
    labels = components(links)
    keyed = texts.groupBy("rep").agg(F.array(*(F.max(b) for b in names)).alias("keys"))  # texts may share an id
    found = settle(_compared(_unsettled(held, labels), candidates.join(keyed.withColumnRenamed("rep", "doc_id"), "doc_id"), idf, threshold))
    if found.limit(1).count():
        links = links.unionByName(found)
        labels = components(links)
    classes = texts.select("t1", "t2", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "t1", "t2", "rep", F.coalesce("class_id", "rep").alias("class_id")
    )
    return signed, settle(classes), links


def _verified(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs whose texts are similar. Joined by sorting at every size, so that pairs of one text come together."""
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")).hint("merge"), "b")
    with_a = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")).hint("merge"), "a")
    return with_a.select("a", "b", "ta", "tb").mapInArrow(_similar(idf, threshold), "a long, b long, similarity double")


def _unsettled(held: DataFrame, labels: DataFrame) -> DataFrame:
    """``held`` with classes, without the pivots, which were compared with all others, and without the buckets that are left with one class."""
    named = settle(held.where("rep <> pivot").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "key", "rep", F.coalesce("class_id", "rep").alias("class_id")
    ).distinct())
    several = named.groupBy("band", "key").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high")
    return settle(named.join(settle(several.select("band", "key")).hint("merge"), ["band", "key"]))


def _compared(held: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Links between texts of one bucket and different classes: a forest at least of those of each tile."""
    bucket = ["band", "key"]
    sized = settle(held.join(texts.select(F.col("doc_id").alias("rep"), F.octet_length("text").alias("bytes")).hint("merge"), "rep"))
    by_class = sized.groupBy(*bucket, "class_id").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    apart = F.col("n") >= BLOCK
    by_class = settle(by_class.select(*bucket, "class_id", "n", "bytes", apart.alias("apart"), F.when(apart, F.col("class_id")).otherwise(0).alias("pool")))
    pool = [*bucket, "apart", "pool"]
    most = F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES), F.lit(1)).cast("int")
    pools = settle(by_class.groupBy(*pool).agg(most.alias("blocks")))
    dealt = by_class.select(*pool, "class_id").join(pools.hint("merge"), pool)
    place = F.pmod(F.xxhash64(F.lit(3), "rep"), F.col("blocks")).alias("place")
    members = settle(held.join(dealt.hint("merge"), [*bucket, "class_id"]).select(*pool, place, "rep", "class_id"))

    blocks = settle(members.select(*pool, "place").distinct()).select(*bucket, F.struct("apart", "pool", "place").alias("x"))
    both = blocks.join(blocks.withColumnRenamed("x", "y"), bucket).where(
        "x <= y AND NOT (x.apart AND y.apart AND x.pool = y.pool)"  # a class is not compared with itself
    )
    sides = both.select(*bucket, "x", "y", F.explode(F.when(F.expr("x = y"), F.array("x")).otherwise(F.array("x", "y"))).alias("of"))
    sides = sides.select(*bucket, "x", "y", F.expr("of = x").alias("side"), "of.apart", "of.pool", "of.place")
    rows = settle(sides.join(members.hint("merge"), [*pool, "place"]).select(*bucket, "x", "y", "side", "rep", "class_id"))
    with_texts = rows.join(texts.select(F.col("doc_id").alias("rep"), "text", "keys").hint("merge"), "rep")
    tiles = with_texts.groupBy(*bucket, "x", "y").agg(F.collect_list(F.struct("rep", "class_id", "side", "keys", "text")).alias("members"))
    found = tiles.select("band", F.expr("x = y").alias("whole"), "members").mapInArrow(
        _similar_in_tiles(idf, threshold), "a long, b long, similarity double"
    )
    return found.dropDuplicates(["a", "b"])


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 12, rows: int = 4) -> DataFrame:
    """``doc_id``, ``class_id``, ``class_size`` and ``n_links`` (links of its text to other texts that were verified)."""
    signed, classes, links = link_texts(docs, threshold, bands, rows)
    degrees = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    copies = settle(signed.groupBy("t1", "t2").agg(F.count("*").alias("n")).join(classes, ["t1", "t2"]))
    sizes = copies.groupBy("class_id").agg(F.sum("n").alias("class_size"))
    looked_up = settle(
        classes.join(degrees, "rep", "left").join(sizes, "class_id").select(
            "t1", "t2", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links")
        )
    )
    return signed.select("doc_id", "t1", "t2").join(looked_up, ["t1", "t2"]).select("doc_id", "class_id", "class_size", "n_links")


def keep_first(docs: DataFrame, threshold: float = 0.8, bands: int = 12, rows: int = 4) -> DataFrame:
    """One row of ``docs`` per class: the one whose ``doc_id`` names it; of rows that repeat it, one."""
    _, classes, _ = link_texts(docs, threshold, bands, rows)
    names = {name: fresh(docs, f"_{name}") for name in ("t1", "t2", "rep")}
    firsts = classes.where("rep = class_id").select(*(F.col(name).alias(new) for name, new in names.items()))
    text = F.coalesce("text", F.lit(""))
    t1, t2, rep = (F.col(new) for new in names.values())
    out = docs.join(firsts, (own_id() == rep) & (F.xxhash64(text) == t1) & (F.xxhash64(F.lit(1), text) == t2))
    return out.dropDuplicates(list(names.values())).select(*(F.col(f"`{c}`") for c in docs.columns))
