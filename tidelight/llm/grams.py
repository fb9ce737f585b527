"""Words of whole texts by byte classes, and keys of runs of words, over Arrow arrays.

All separators are ASCII, so texts are cut on their UTF-8 bytes: a table of 256 entries says which bytes part words and
which also end a piece. A to Z are lower-cased; no other character changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidelight.llm import words as w

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def byte_classes(space: bytes, ending: bytes = b"") -> np.ndarray:
    """0 for bytes of words, 1 for those between words, 2 for those that also end a piece."""
    classes = np.zeros(256, np.uint8)
    classes[list(space)] = 1
    classes[list(ending)] = 2
    return classes


@dataclass
class Words:
    """The words of some texts in their order."""

    owner: np.ndarray  # row of each word
    piece: np.ndarray  # number of the piece that it lies in; pieces never span texts
    code: np.ndarray  # place of each word in ``distinct``
    distinct: pa.Array

    def __len__(self) -> int:
        return len(self.owner)


def cut_words(texts: pa.Array, classes: np.ndarray) -> Words:
    """Null texts count as empty ones."""
    texts = w.whole(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = classes[data]
    inside = kind == 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]  # where texts begin, whatever stands before
    begins[heads] = inside[heads]
    tails = heads[1:] - 1
    ends[tails] = inside[tails]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, pa.array([], pa.large_string()))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    piece = owner + np.searchsorted(np.flatnonzero(kind == 2), starts)
    kept = _LOWER[data[inside]]
    places = np.concatenate([[0], np.cumsum(stops - starts + 1)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(kept))
    code, distinct = w.encode(words)
    return Words(owner, piece, code, distinct)


def pieces_of_texts(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches of about ``size`` bytes of text, with that column; a longer text is alone."""
    for batch in batches:
        for start, part in w.chunks(batch.column(column), size):
            yield batch.slice(start, len(part)), part


def chain(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of runs that are one word longer."""
    with np.errstate(over="ignore"):
        return w.mix(keys * _BASE + words)


def seeded(seeds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of single words, told apart by a seed (the language of each)."""
    with np.errstate(over="ignore"):
        return w.mix(seeds * _BASE + words)
