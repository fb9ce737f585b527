"""Importance resampling towards a target table, with exact ranks by parallel sorting by regular sampling.

Texts are hashed into buckets by their words and pairs of words; the bucket counts of the documents and of the target give
each bucket a gain, an array of ``buckets`` numbers that every task holds. A document's weight is the mean gain of its features.
Adding a random number of Gumbel's distribution to it and taking the highest scores is sampling without replacement in proportion
to the exponential of the weight; the random number comes from a hash of the id, so that a draw can be repeated.

The ranking is sorting by regular sampling: every task sorts its rows and writes them as a run; each run gives rows at
regular places, of which regular ones become splitters; segments between splitters are exchanged, each is sorted on its own, and
the segments' counts before it make its rows' places exact ranks. The driver holds the splitters only, at most one per segment.

* A null or empty text has no features and weight 0. A null ``doc_id`` counts as an empty text in the hash and comes last in ties.
* Ties of score go to the smaller ``doc_id``; rows that repeat an id follow by weight and number of features. Repeated rows are ranked each.
* Texts of any length are read whole. An empty table has no rows; an empty target has no features, which gives every bucket a gain.
* Columns other than ``doc_id`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelight.llm import words as w
from tidelight.llm.grams import byte_classes, cut_words, pieces_of_texts
from tidelight.session import settle

BUCKETS = 10_000
CHUNK = 2 << 20
# Everything in ASCII but digits and letters parts words.
APART = byte_classes(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_POLYNOMIAL = 0xEDB88320  # fixed value: of CRC-32, lowest bit first
_LAST = 2**63 - 1


def _times(matrix: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The 32x32 bit matrix (a number per bit of the argument) applied to each number."""
    out = np.zeros_like(rows)
    for bit in range(32):
        out ^= np.where(rows >> np.uint32(bit) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


def _shifts(count: int) -> list[np.ndarray]:
    """For 1, 2, 4, ... zero bytes behind a text: what they make of its CRC, as four tables of 256, one per byte of the CRC."""
    one_bit = np.append(np.uint32(_POLYNOMIAL), np.uint32(1) << np.arange(31, dtype=np.uint32)).astype(np.uint32)
    matrix = one_bit
    for _ in range(3):  # eight bits
        matrix = _times(matrix, matrix)
    tables = []
    for _ in range(count):
        tables.append(np.stack([_times(matrix, np.arange(256, dtype=np.uint32) << np.uint32(8 * at)) for at in range(4)]))
        matrix = _times(matrix, matrix)
    return tables


_SHIFTS = _shifts(40)


def join_crc(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two texts in a row, from those of both and the byte length of the second."""
    out = first.copy()
    for at in range(int(size.max(initial=0)).bit_length()):
        odd = np.flatnonzero(size >> at & 1)
        crc, table = out[odd], _SHIFTS[at]
        low = np.uint32(255)
        out[odd] = (
            table[0][crc & low] ^ table[1][crc >> np.uint32(8) & low] ^ table[2][crc >> np.uint32(16) & low] ^ table[3][crc >> np.uint32(24)]
        )
    return out ^ second


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row of each word, and the row and the bucket of each feature: all words, then all pairs of neighbours."""
    words = cut_words(texts, APART)
    distinct = [x.encode() for x in words.distinct.to_pylist()]
    crc = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct))
    blank = np.fromiter((zlib.crc32(b" ", c) for c in crc.tolist()), np.uint32, len(distinct))
    size = np.fromiter(map(len, distinct), np.int64, len(distinct))
    code = words.code
    paired = np.flatnonzero(words.owner[1:] == words.owner[:-1])
    second = code[1:][paired]
    pairs = join_crc(blank[code[:-1][paired]], crc[second], size[second])
    owner = np.concatenate([words.owner, words.owner[paired]])
    return words.owner, owner, np.concatenate([crc[code], pairs]).astype(np.int64) % buckets


def bucket_counts(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``: the features of all texts. A task sends at most one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, part in pieces_of_texts(batches, "text", CHUNK):
            total += np.bincount(features(part, buckets)[2], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return table.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln(((t + 1) (S + buckets)) / ((s + 1) (T + buckets)))) of each bucket."""
    spark = docs.sparkSession
    sides = bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    per_bucket = spark.range(buckets).select(F.col("id").alias("bucket")).join(
        F.broadcast(sides.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))), "bucket", "left"
    ).na.fill(0)
    pinned = settle(per_bucket)
    totals = pinned.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    one = F.lit(1.0)
    ratio = ((F.col("t") + one) * (F.col("all_s") + buckets)) / ((F.col("s") + one) * (F.col("all_t") + buckets))
    found = pinned.join(F.broadcast(totals)).select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))
    return found.orderBy("bucket").toArrow().column("gain").to_numpy()


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` (the floored mean gain of the features) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains(docs, target, buckets))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in pieces_of_texts(batches, "text", CHUNK):
            words, owner, at = features(part, buckets)
            count = w.per_text(owner, None, len(part))
            total = np.zeros(len(part), np.int64)
            np.add.at(total, owner, shared.value[at])
            mean = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x) for x in (w.per_text(words, None, len(part)), count, mean))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(measure, "doc_id long, n_words long, n_features long, weight long")


def gumbel_score(seed: int) -> F.Column:
    """The weight and a Gumbel number drawn by a hash of seed and id, in thousandths."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    even = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(even))).cast("long")


def _splitters(runs: DataFrame, keys: list[str], segments: int, per_run: int) -> list[tuple]:
    """Regular ones of the rows at ``per_run`` regular places of every run; at most ``segments`` - 1."""
    sizes = runs.groupBy("_run").agg(F.count("*").alias("_size"))
    steps = sizes.select("_run", F.expr(f"greatest(1L, _size div {per_run})").alias("_step"))
    regular = runs.join(F.broadcast(steps), "_run").where("_at % _step = _step div 2")  # one row per run is broadcast
    rank = F.row_number().over(Window.orderBy(*keys))  # at most 2 per_run rows a run
    count = F.count("*").over(Window.partitionBy())
    placed = regular.select(*keys, rank.alias("_rank"), count.alias("_all"))
    passed = f"(_rank * {segments}) div _all > ((_rank - 1) * {segments}) div _all"  # the next of equal parts is reached
    picked = placed.where(f"{passed} AND _rank < _all").orderBy("_rank").limit(segments - 1)
    return [tuple(row) for row in picked.select(*keys).collect()]


def ranked(scored: DataFrame, keys: list[str], segments: int, per_run: int = 64) -> DataFrame:
    """``scored`` and ``rank`` (from 1) in the order of the long columns ``keys``, all ascending and none null."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    local = scored.sortWithinPartitions(*keys)
    runs = settle(local.withColumns({"_run": F.spark_partition_id(), "_at": place}))
    splitters = _splitters(runs, keys, segments, per_run)
    shared = scored.sparkSession.sparkContext.broadcast(np.array(splitters, np.int64).reshape(-1, len(keys)))

    @F.arrow_udf("int")
    def segment(*columns: pa.Array) -> pa.Array:
        """How many splitters lie at or before each row."""
        bounds = shared.value
        values = [np.concatenate([b, c.to_numpy()]) for b, c in zip(bounds.T, columns)]
        is_row = np.arange(len(values[0])) >= len(bounds)
        order = np.lexsort([is_row, *reversed(values)])
        passed = np.empty(len(order), np.int32)
        passed[order] = np.cumsum(~is_row[order])
        return pa.array(passed[len(bounds) :], pa.int32())

    dealt = runs.drop("_run", "_at").withColumn("_segment", segment(*keys))
    merged = dealt.repartitionById(segments, F.col("_segment")).sortWithinPartitions(*keys)
    pinned = settle(merged.withColumn("_at", place))
    before = Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    counts = pinned.groupBy("_segment").agg(F.count("*").alias("_n"))
    offsets = counts.select("_segment", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = pinned.join(F.broadcast(offsets), "_segment")
    return out.select(*scored.columns, (F.col("_before") + F.col("_at") + 1).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = BUCKETS,
    segments: int | None = None,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null where not drawn) of every row.

    Of the documents with ``min_words`` words or more the ``percent`` percent with the highest scores are drawn. ``segments``
    is how many sorted segments there are; by default as many as the session has shuffle partitions.
    """
    segments = segments or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = settle(weigh(docs, target, buckets).withColumn("score", gumbel_score(seed)))
    ready = F.col("n_words") >= min_words
    order = {"_down": -F.col("score"), "_id": F.coalesce("doc_id", F.lit(_LAST))}
    keyed = scored.where(ready).withColumns(order)
    placed = ranked(keyed, ["_down", "_id", "weight", "n_features"], segments)
    wanted = keyed.count() * percent // 100
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.where(~ready).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return drawn.select(*columns).unionByName(rest.select(*columns))
