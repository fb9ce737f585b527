"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Every paragraph of a text (a line, cut after sentence ends) has a 64-bit digest; repeats are told apart by their number. Each
digest is added to one cell in each of three parts of a sketch: a count, the sum (xor) of digests, and the sum of their check
values. The sketch of one version subtracted from another's leaves only what differs, and cells that hold one digest
peel it off until nothing is left. If peeling stops early, both sketches are made anew at twice the size.

Likeness is shared digests over all distinct digests of both (1 for two texts without paragraphs).

* A null text is an empty text; an empty text has the sketch without entries. Equal texts have equal fingerprints.
* Rows that repeat a ``doc_id`` follow each other in the order of their texts.
* Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelight.llm import words as w

_SENTENCE = re.compile(r"\n|(?<=[.!?])\s")
PARTS = 3
BASE_CELLS = 8  # in each part


def paragraph_digests(text: str) -> list[int]:
    """Different digests of the paragraphs with content; the n-th repeat has a digest of its own.

    The number of a repeat is hashed with the text, not taken as the hash's seed: seeds of short texts give equal digests for
    different texts, and a digest that occurs twice cannot be peeled.
    """
    seen: dict[str, int] = {}
    digests: dict[int, None] = {}
    for piece in _SENTENCE.split(text):
        piece = piece.strip()
        if piece:
            nth = seen.get(piece, 0)
            seen[piece] = nth + 1
            while (digest := xxhash.xxh3_64_intdigest(f"{piece}\n{nth}".encode("utf-8", "surrogatepass"))) in digests:
                nth += 1  # as if repeated: the same for equal texts
            digests[digest] = None
    return list(digests)


def _check(digests: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return w.mix(digests * np.uint64(0x9FB21C651E98DF25) + np.uint64(1))


class Sketches:
    """Many sketches in one: counts, digest sums and check sums of the ``PARTS * sizes[i]`` cells of each sketch i."""

    def __init__(self, sizes: np.ndarray) -> None:
        self.sizes = sizes
        self.offsets = np.concatenate([[0], np.cumsum(PARTS * sizes)])
        self.counts = np.zeros(self.offsets[-1], np.int64)
        self.digests = np.zeros(self.offsets[-1], np.uint64)
        self.checks = np.zeros(self.offsets[-1], np.uint64)

    def cells(self, owner: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """One cell in each part, by row."""
        size = self.sizes[owner].astype(np.uint64)
        mixed = w.mix(digests)
        picks = [mixed >> np.uint64(21 * part) & np.uint64((1 << 21) - 1) for part in range(PARTS)]
        places = [(pick % size).astype(np.int64) + part * self.sizes[owner] for part, pick in enumerate(picks)]
        return np.stack(places, 1) + self.offsets[owner][:, None]

    def add(self, owner: np.ndarray, digests: np.ndarray, counts: np.ndarray) -> None:
        at = self.cells(owner, digests).reshape(-1)
        np.add.at(self.counts, at, np.repeat(counts, PARTS))
        np.bitwise_xor.at(self.digests, at, np.repeat(digests, PARTS))
        np.bitwise_xor.at(self.checks, at, np.repeat(_check(digests), PARTS))

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.sizes)
        out.counts = self.counts - other.counts
        out.digests = self.digests ^ other.digests
        out.checks = self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owner, digest and count (1: first version alone, -1: second) of what is recovered, and which sketches ended empty."""
        of_cell = np.repeat(np.arange(len(self.sizes)), PARTS * self.sizes)
        owners, found, signs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        while True:
            at = np.flatnonzero(np.abs(self.counts) == 1)
            at = at[_check(self.digests[at]) == self.checks[at]]
            at = at[(self.cells(of_cell[at], self.digests[at]) == at[:, None]).any(1)]
            with np.errstate(over="ignore"):
                _, once = np.unique(w.mix(self.digests[at] + w.mix(of_cell[at].astype(np.uint64))), return_index=True)
            at = at[once]
            if not len(at):
                break
            owner, digests, counts = of_cell[at], self.digests[at], self.counts[at]
            self.add(owner, digests, -counts)
            owners.append(owner), found.append(digests), signs.append(counts)
        left = (self.counts != 0) | (self.digests != 0)
        empty = np.bincount(of_cell[left], minlength=len(self.sizes)) == 0
        return np.concatenate(owners), np.concatenate(found), np.concatenate(signs), empty

    def texts(self) -> list[str]:
        """Each sketch's cells as hex, the same for the same digests."""
        cells = np.zeros(len(self.counts), [("count", "<i4"), ("digest", "<u8"), ("check", "<u4")])
        cells["count"], cells["digest"], cells["check"] = self.counts, self.digests, self.checks >> np.uint64(32)
        return [cells[a:b].tobytes().hex() for a, b in zip(self.offsets[:-1], self.offsets[1:])]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return owner, np.array([digest for x in lists for digest in x], np.uint64)


def sketches(digests: list[list[int]], size: int = BASE_CELLS) -> Sketches:
    out = Sketches(np.full(len(digests), size))
    owner, flat = _flat(digests)
    out.add(owner, flat, np.ones(len(flat), np.int64))
    return out


def differences(first: list[list[int]], second: list[list[int]], size: int = BASE_CELLS) -> list[tuple[list[int], list[int]]]:
    """For each pair of versions the digests that only the first and that only the second has: their sketches are
    subtracted and peeled, and those that fail are made anew with twice the cells."""
    out: list[tuple[list[int], list[int]]] = [([], []) for _ in first]
    waiting = list(range(len(first)))
    while waiting:
        mine, yours = [first[i] for i in waiting], [second[i] for i in waiting]
        owners, found, signs, empty = sketches(mine, size).minus(sketches(yours, size)).peel()
        for owner, digest, sign in zip(owners.tolist(), found.tolist(), signs.tolist()):
            if empty[owner]:
                out[waiting[owner]][sign < 0].append(digest)
        waiting = [i for i, done in zip(waiting, empty.tolist()) if not done]
        size *= 2
    return out


def likeness(first: list[int], only_first: list[int], only_second: list[int]) -> float:
    shared = len(first) - len(only_first)
    union = shared + len(only_first) + len(only_second)
    return shared / union if union else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, n_paragraphs long, n_edited_only long, n_own_only long"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and descending id, each followed by the text after it; guests are followed only."""
    last: tuple | None = None  # range, id, text, digests of the row that waits for the next
    names = [field.split()[0] for field in _RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, *[pa.int64()] * 3]
    for batch in batches:
        for start, texts in w.chunks(batch.column("text"), 1 << 20):
            others = (batch.column(n).slice(start, len(texts)).to_pylist() for n in ("part", "guest", "doc_id"))
            heads, own, new, following = [], [], [], []
            for part, guest, doc_id, text in zip(*others, texts):
                text = text.as_py()
                digests = paragraph_digests(text)
                if last is not None and last[0] == part:
                    change = edited(last[2], text)
                    heads.append((last[1], len(last[2]), hashlib.sha256(change.encode("utf-8", "surrogatepass")).hexdigest()))
                    own.append(last[3]), new.append(paragraph_digests(change)), following.append(digests)
                last = None if guest else (part, doc_id, text, digests)
            if not heads:
                continue
            to_new, to_next = differences(own, new), differences(own, following)
            rows = [
                (*head, print_, new_print, likeness(mine, *d), likeness(mine, *e), len(mine), len(d[1]), len(d[0]))
                for head, print_, new_print, mine, d, e in zip(heads, sketches(own).texts(), sketches(new).texts(), own, to_new, to_next)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)


def fingerprint_documents(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited version, and the likeness to that and to the next document.

    The next document is the one with the next smaller ``doc_id``, and after the last the first. Ids are cut into
    ranges of about equal counts; each text goes to its range once, and the first row of a range also to the range
    before, where the last row needs it. Rows without an id come last. One shuffle of the texts, in any order of files.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    if ranges is None:
        ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [at / ranges for at in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("key", F.array(*map(F.lit, steps)), 10 * ranges).alias("c")).head().c if steps else []
    bounds = np.unique(np.array(cuts or [], np.int64))  # as many as there are ranges

    def place(keys: np.ndarray) -> np.ndarray:
        # Descending ids: the range of the largest is 0.
        return (len(bounds) - np.searchsorted(bounds, keys, side="right")).astype(np.int32)

    @F.arrow_udf("int")
    def range_of(keys: pa.Array) -> pa.Array:
        return pa.array(place(keys.to_numpy(zero_copy_only=False)))

    firsts = rows.select("key").groupBy(range_of("key").alias("part")).agg(F.max("key").alias("key")).orderBy("part").collect()
    order = [row.part for row in firsts]  # as many as there are ranges
    before = {row.key: order[at - 1] for at, row in enumerate(firsts)}  # the first range follows the last

    # One call per row, so that a task needs one Python worker.
    @F.arrow_udf("struct<part:int,host:int>")
    def places(keys: pa.Array) -> pa.Array:
        hosts = pa.array([before.get(key) for key in keys.to_pylist()], pa.int32())
        return pa.StructArray.from_arrays([pa.array(place(keys.to_numpy(zero_copy_only=False))), hosts], ["part", "host"])

    placed = rows.withColumn("at", places("key"))
    own = F.struct(F.col("at.part").alias("part"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("at.host").alias("part"), F.lit(True).alias("guest"))
    targets = F.when(F.col("at.host").isNull(), F.array(own)).otherwise(F.array(own, visit))
    dealt = placed.select(F.explode(targets).alias("to"), "key", "doc_id", "text")
    dealt = dealt.select("to.part", "to.guest", "key", "doc_id", "text")
    # A guest comes behind all rows of the range that it visits, even if that is its own.
    ordered = dealt.repartition("part").sortWithinPartitions("part", "guest", F.desc("key"), "text")
    return ordered.mapInArrow(_compare, _RESULT)
