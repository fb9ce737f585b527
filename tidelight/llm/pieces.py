"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The pieces and their scores come from a model file; of all ways to cut a text into pieces, the one of the highest total
score is taken. A character that no piece covers costs the lowest score less 10 and is written as its UTF-8 bytes.
On equal totals the longer last piece wins. The file may hold a BPE vocabulary; its scores then are negated
merge ranks, and the best-scoring cut is not the one that merging would give.

The search keeps the positions since the last commitment only. All future pieces start within the longest piece's
length of the end, so when the back pointers of all those positions lead to one boundary, everything before it is
final and is handed out.

Where no piece can cross (a blank after another character, both sides of a line feed), the paths converge by
themselves, whatever the scores; texts are cut there first, on their UTF-8 bytes, and each different word of a chunk of texts is looked up once,
as the ids of frequent words are remembered. Short stretches between such cuts that are new are searched side by side, as arrays;
anything longer is streamed.

* A null text gives null ids, an empty text no ids. The blank U+2581 of the text itself is written as bytes, so that
  decoding gives back every text exactly.
* Other columns pass through, whatever their names; an existing column of the output's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelight.llm import words as w

_BLANK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000
_NEVER = float("-inf")
REMEMBERED_LENGTH = 48


class Vocabulary:
    """Pieces of a SentencePiece model, with blanks as spaces."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], size: int) -> None:
        self.scores = {text: score for text, (_, score) in pieces.items()}
        self.ids = {text: number for text, (number, _) in pieces.items()}
        self.byte_ids = byte_ids
        self.longest = max(map(len, pieces))
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.tree: dict = {}  # by character: the deeper tree, and the score of the piece that ends here
        for text, score in self.scores.items():
            children = self.tree
            for char in text[:-1]:
                children = children.setdefault(char, [{}, None])[0]
            children.setdefault(text[-1], [{}, None])[1] = score
        self.bytes_of = [b""] * size
        for text, number in self.ids.items():
            self.bytes_of[number] = text.encode()
        for value, number in enumerate(byte_ids):
            self.bytes_of[number] = bytes([value])
        # Pieces that cross what would be cuts else.
        self.blank_inside = any(" " in text.lstrip(" ") for text in self.ids)
        self.feed_joined = any("\n" in text and len(text) > 1 for text in self.ids)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Which bytes begin a word, apart from the first of a text: cuts that no piece crosses."""
        new = np.zeros(len(data), bool)
        if self.blank_inside or not len(data):
            return new
        blank = data == ord(" ")
        new[1:] = blank[1:] & ~blank[:-1]
        if not self.feed_joined:
            feed = data == ord("\n")
            new |= feed
            new[1:] |= feed[:-1]
        return new

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte_ids = [model.piece_to_id(f"<0x{value:02X}>") for value in range(256)]
        special = {n for n in range(size) if model.is_unknown(n) or model.is_control(n) or model.is_unused(n)}
        pieces = {
            model.id_to_piece(n).replace(_BLANK, " "): (n, model.get_score(n))
            for n in range(size)
            if n not in special and not model.is_byte(n)
        }
        return cls(pieces, byte_ids, size)

    def emit(self, piece: str) -> list[int]:
        number = self.ids.get(piece)
        return [number] if number is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]


def stream_pieces(text: str, vocabulary: Vocabulary) -> Iterator[tuple[int, str]]:
    """Start and text of the pieces of the best cut, each as soon as it is final."""
    tree, longest, unknown = vocabulary.tree, vocabulary.longest, vocabulary.unknown
    size, step = len(text), 2 * vocabulary.longest
    base = 0  # the last commitment; the lists hold the positions from there on
    room = min(size, step + longest) + 1
    best, back = [_NEVER] * room, [0] * room
    best[0] = 0.0
    due = min(size, step)
    for start in range(size):
        at = start - base
        reached = best[at]
        children = tree
        for end, char in enumerate(text[start : start + longest], at + 1):
            node = children.get(char)
            if node is None:
                break
            children, score = node
            if score is not None and reached + score > best[end]:
                best[end] = reached + score
                back[end] = start
        if text[start] not in vocabulary.ids and reached + unknown > best[at + 1]:
            best[at + 1] = reached + unknown
            back[at + 1] = start
        done = start + 1  # its score and all before it are final
        if done != due:
            continue
        # Later pieces start here, or have ended beyond and started at these.
        paths = {done} | {start for start, score in zip(back[done - base + 1 :], best[done - base + 1 :]) if score > _NEVER}
        while len(paths) > 1:
            last = max(paths)
            paths.remove(last)
            paths.add(back[last - base])
        boundary = paths.pop()
        if boundary > base:
            cuts = [boundary]
            while cuts[-1] > base:
                cuts.append(back[cuts[-1] - base])
            for first, stop in zip(cuts[::-1], cuts[-2::-1]):
                yield first, text[first:stop]
            top = best[boundary - base]
            best = [score - top for score in best[boundary - base :]]
            back = back[boundary - base :]
            back[0] = base = boundary
        due = min(size, done + step)
        missing = min(size, due + longest) - base + 1 - len(best)
        best += [_NEVER] * missing
        back += [base] * missing


class _Arrays:
    """The vocabulary's tree as arrays: edges by node and character, and each node's piece."""

    BITS = 18

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.chars = np.zeros(0x110000, np.int32)  # 0: in no piece
        known = sorted({char for text in vocabulary.ids for char in text})
        self.chars[[ord(char) for char in known]] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        nodes, edges = [None], {}
        waiting = [(0, vocabulary.tree, "")]
        while waiting:
            at, children, text = waiting.pop()
            for char, (deeper, _) in children.items():
                edges[at * self.width + int(self.chars[ord(char)])] = len(nodes)
                waiting.append((len(nodes), deeper, text + char))
                nodes.append(text + char)
        self.root = np.full(self.width, -1, np.int64)  # the nodes of single characters
        for char, node in ((key, node) for key, node in edges.items() if key < self.width):
            self.root[char] = node
        # Edges in tables of one key a slot; those that find theirs taken go to the next table.
        self.tables = []
        keys, targets = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int64)
        while len(keys):
            slots, first = np.unique(self.slot(keys, len(self.tables)), return_index=True)
            held, at = np.full(1 << self.BITS, -1, np.int64), np.full(1 << self.BITS, -1, np.int64)
            held[slots], at[slots] = keys[first], targets[first]
            self.tables.append((held, at))
            keys, targets = np.delete(keys, first), np.delete(targets, first)
        self.scores = np.array([vocabulary.scores.get(text, np.nan) if text else np.nan for text in nodes])
        self.ids = np.array([vocabulary.ids.get(text, -1) if text else -1 for text in nodes], np.int32)
        self.single = np.zeros(self.width, bool)  # characters that are pieces themselves
        self.single[[self.chars[ord(char)] for char in known if char in vocabulary.ids]] = True
        self.longest = vocabulary.longest

    def slot(self, keys: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * table & (1 << 64) - 1)
        return (spread >> np.uint64(64 - self.BITS)).view(np.int64)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The node after each character, or -1."""
        keys = nodes * self.width + chars
        out = np.full(len(keys), -1, np.int64)
        rows = np.arange(len(keys))
        for table, (held, targets) in enumerate(self.tables):
            at = self.slot(keys, table)
            there = held[at]
            hit = there == keys
            out[rows[hit]] = targets[at[hit]]
            other = np.flatnonzero(~hit & (there >= 0))  # an empty slot: no such edge
            if not len(other):
                break
            rows, keys = rows[other], keys[other]
        return out

    def search(self, words: list[str]) -> tuple[np.ndarray, list[bytes | None]]:
        """Ids of each word's best cut, as bytes; None for words with characters that are no pieces."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array(list(map(len, words)))
        order = np.argsort(-lengths, kind="stable")  # the longest first, so that those still going are in front
        ends = np.cumsum(lengths)
        lengths = lengths[order]
        most = int(lengths[0])
        chars = np.zeros((len(words), most + 1), np.int32)
        rows = np.repeat(np.arange(len(words)), lengths)
        columns = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        chars[rows, columns] = self.chars[points[np.repeat(ends[order] - lengths, lengths) + columns]]
        plain = np.ones(len(words), bool)
        plain[rows[~self.single[chars[rows, columns]]]] = False
        best = np.full((len(words), most + 1), _NEVER)
        best[:, 0] = 0.0
        back = np.zeros((len(words), most + 1), np.int32)
        piece = np.full((len(words), most + 1), -1, np.int32)
        going = len(words) - np.searchsorted(lengths[::-1], np.arange(most), side="right")  # longer than each position
        for start in range(most):
            alive = np.arange(going[start])
            for end in range(start, min(most, start + self.longest)):
                nodes = self.step(nodes, chars[alive, end]) if end > start else self.root[chars[alive, end]]
                on = nodes >= 0
                alive, nodes = alive[on], nodes[on]
                if not len(alive):
                    break
                total = best[alive, start] + self.scores[nodes]
                better = total > best[alive, end + 1]  # not a number where no piece ends
                at = alive[better]
                best[at, end + 1], back[at, end + 1], piece[at, end + 1] = total[better], start, self.ids[nodes[better]]
        ids = np.full((len(words), most), -1, np.int32)  # from the right
        place = lengths.astype(np.int64)
        column = most
        open_rows = np.flatnonzero(plain)
        while len(open_rows):
            column -= 1
            ids[open_rows, column] = piece[open_rows, place[open_rows]]
            place[open_rows] = back[open_rows, place[open_rows]]
            open_rows = open_rows[place[open_rows] > 0]
        filled = ids >= 0
        stops = np.cumsum(filled.sum(1)) * 4
        flat = ids[filled].tobytes()
        found = [flat[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]
        return order, [bytes_ if ok else None for bytes_, ok in zip(found, plain.tolist())]


class _Memory(dict):
    """Ids of words met before, as bytes; forgets everything when full."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.arrays = _Arrays(vocabulary)

    def __missing__(self, word: str) -> bytes:
        ids = [number for _, piece in stream_pieces(word, self.vocabulary) for number in self.vocabulary.emit(piece)]
        packed = np.array(ids, np.int32).tobytes()
        if len(word) <= REMEMBERED_LENGTH:
            self[word] = packed
        return packed

    def learn(self, words: Iterable[str]) -> None:
        """Remember the short ones of these words."""
        new = [word for word in words if word not in self and len(word) <= REMEMBERED_LENGTH]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = [word for word in words if len(word) <= REMEMBERED_LENGTH]
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            order, found = self.arrays.search(part)
            for at, packed in zip(order.tolist(), found):
                if packed is not None:
                    self[part[at]] = packed


@lru_cache(2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary.read(path)


@lru_cache(2)
def _memory(path: str) -> _Memory:
    return _Memory(_vocabulary(path))


def encode_array(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and where each text's begin and the last one's end. Null texts count as empty ones."""
    memory = _memory(path)
    texts = w.whole(texts)
    texts = pc.binary_join_element_wise(pc.if_else(pc.equal(texts, ""), "", " ").cast(pa.large_string()), texts, pa.scalar("", pa.large_string()))
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if not bounds[-1]:
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[: bounds[-1]]
    new = memory.vocabulary.cuts(data)
    new[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    starts = np.flatnonzero(new)
    places = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    code, distinct = w.encode(pa.LargeStringArray.from_buffers(len(starts), places, texts.buffers()[2]))
    words = distinct.to_pylist()
    memory.learn(words)
    packed = list(map(memory.__getitem__, words))
    known = np.frombuffer(b"".join(packed), np.int32)
    sizes = np.array(list(map(len, packed)), np.int64) // 4
    first = np.cumsum(sizes) - sizes
    count = sizes[code]
    ends = np.append(0, np.cumsum(count))
    ids = known[np.repeat(first[code] - ends[:-1], count) + np.arange(ends[-1])]
    return ids, ends[np.searchsorted(starts, bounds)]


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    ids, bounds = encode_array(pa.array(texts, pa.large_string()), path)
    return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


@lru_cache(2)
def _bytes_of(path: str) -> pa.Array:
    return pa.array(_vocabulary(path).bytes_of, pa.binary())


def decode_ids(ids: np.ndarray, path: str) -> str:
    return b"".join(map(_vocabulary(path).bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


def decode_array(lists: pa.Array, path: str) -> pa.Array:
    """The text of each list of ids, null for a null list."""
    offsets = pa.array(lists.offsets.to_numpy())  # without those before a slice
    parts = pa.ListArray.from_arrays(offsets, _bytes_of(path).take(lists.values), mask=lists.is_null())
    joined = pc.binary_join(parts, b"")
    try:
        whole = joined.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no text
        whole = pa.array([x if x is None else x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
    return pc.utf8_slice_codeunits(whole, 1)


def encode(docs: DataFrame, model: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text in the column ``to`` (array of int)."""

    @F.arrow_udf("array<int>")
    def to_ids(texts: pa.Array) -> pa.Array:
        offsets, parts, total = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)], 0
        for _, part in w.chunks(texts):
            ids, bounds = encode_array(part, model)
            parts.append(ids)
            offsets.append(total + bounds[1:])
            total += len(ids)
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate(offsets), pa.int32()), pa.array(np.concatenate(parts)), mask=texts.is_null()
        )

    return docs.withColumn(to, to_ids(F.col(text)))


def decode(docs: DataFrame, model: str, ids: str = "ids", to: str = "text") -> DataFrame:
    """``docs`` with the text of each row's ids in the column ``to``; ids without a text of their own give none."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        return decode_array(lists, model)

    return docs.withColumn(to, texts(F.col(ids)))
