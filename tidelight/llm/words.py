"""Words, lines and their hashes over Arrow arrays of texts, a few megabytes at a time.

A word is a run of characters other than ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of about ``size`` bytes with their first row; a longer text is alone in its slice."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def whole(texts: pa.Array) -> pa.Array:
    """The texts with nulls as empty texts, in an array without offset."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    return pa.concat_arrays([filled]) if filled.offset else filled


def _owners(lists: pa.Array) -> np.ndarray:
    offsets = lists.offsets.to_numpy()
    return np.repeat(np.arange(len(lists), dtype=np.int64), np.diff(offsets))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each word, and the words."""
    lists = pc.ascii_split_whitespace(whole(texts))
    found, owner = lists.flatten(), _owners(lists)
    filled = pc.not_equal(found, "").to_numpy(zero_copy_only=False)
    if not filled.all():
        found, owner = found.filter(pa.array(filled)), owner[filled]
    return owner, found


def split_lines(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    lists = pc.split_pattern(whole(texts), "\n")
    return _owners(lists), lists.flatten()


def encode(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The position of each value among the distinct ones, and these."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes: a polynomial, then mixed with the length."""
    values = pa.concat_arrays([values.cast(pa.large_string())])
    if len(values) == 0:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    lengths = np.diff(offsets)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    with np.errstate(over="ignore"):
        # Powers restart at each string, so that equal strings have equal sums.
        within = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], lengths)
        powers = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, _BASE, np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[within])])
        return mix(sums[offsets[1:]] - sums[offsets[:-1]] + mix(lengths.astype(np.uint64)))


def windows(owner: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``width`` words within one text."""
    count = max(0, len(hashes) - width + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(count, np.uint64)
        for at in range(width):
            total = mix(total * _BASE + hashes[at : at + count])
    inside = np.flatnonzero(owner[:count] == owner[width - 1 :][:count])
    return inside, total[inside]


def per_text(owner: np.ndarray, weights: np.ndarray | None, rows: int) -> np.ndarray:
    """The sum of the weights (or the number) of each text's members."""
    return np.bincount(owner, weights, minlength=rows).astype(np.int64)
