import random

import pyarrow as pa
import pytest

from tidelight.llm import pieces
from tidelight.llm.queries import PIECE_MODEL


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.read(PIECE_MODEL)


def best_cut(text, v):
    best, back = [0.0] + [float("-inf")] * len(text), [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - v.longest), end):
            piece = text[start:end]
            score = v.scores.get(piece, v.unknown if end - start == 1 else None)
            if score is not None and best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    out = []
    while text:
        start = back[len(text)]
        out.append(text[start:])
        text = text[:start]
    return out[::-1]


def samples():
    rng = random.Random(5)
    letters = "aehinorst  ébc日▁\n\t<0x>."
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(60)] + ["a" * 3_000, " " * 700, "<s> </s>", "▁▁"]


def test_the_stream_finds_the_best_cut(vocabulary):
    for text in samples():
        assert [p for _, p in pieces.stream_pieces(text, vocabulary)] == best_cut(text, vocabulary)


def test_pieces_are_handed_out_before_the_end(vocabulary):
    class Watched(str):
        seen = 0

        def __getitem__(self, at):
            self.seen = max(self.seen, at.stop if isinstance(at, slice) else at)
            return str.__getitem__(self, at)

    text = Watched("the house of the rising sun " * 400)
    stream = pieces.stream_pieces(text, vocabulary)
    next(stream)
    assert text.seen < 20 * vocabulary.longest


def test_words_side_by_side_equal_the_stream(vocabulary):
    for text in samples():
        cut = [n for p in best_cut(" " + text, vocabulary) for n in vocabulary.emit(p)] if text else []
        assert pieces.encode_texts([text], PIECE_MODEL)[0].tolist() == cut


def test_memory_may_overflow(vocabulary, monkeypatch):
    want = [x.tolist() for x in pieces.encode_texts(samples(), PIECE_MODEL)]
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    assert [x.tolist() for x in pieces.encode_texts(samples(), PIECE_MODEL)] == want


def test_round_trip(spark, given, awkward, nothing):
    for docs in (given, awkward):
        back = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL, to="again")
        assert back.where("NOT (again <=> text)").count() == 0
        assert back.where("(text IS NULL) <> (ids IS NULL)").count() == 0
    assert pieces.encode(nothing, PIECE_MODEL).count() == 0
    odd = spark.createDataFrame([(t,) for t in samples()], "text string")
    assert pieces.decode(pieces.encode(odd, PIECE_MODEL), PIECE_MODEL, to="again").where("again <> text").count() == 0


def test_decoding_agrees_with_the_library():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for text in ("the house of the rising sun", "éa 日本 x", "two  blanks\nand a line"):
        assert model.decode(pieces.encode_texts([text], PIECE_MODEL)[0].tolist()) == text
        assert pieces.decode_ids(__import__("numpy").array(model.encode(text)), PIECE_MODEL) == text


def test_arrays_of_texts_and_ids(vocabulary):
    texts = pa.array([None, "", " a", *samples(), "é\n", "", None, "x\n\n y  z"])
    for part in (texts, texts.slice(3, 40), texts.slice(len(texts) - 3)):
        ids, bounds = pieces.encode_array(part, PIECE_MODEL)
        cut = [[n for p in best_cut(" " + text, vocabulary) for n in vocabulary.emit(p)] if text else [] for text in part.to_pylist()]
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == cut
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids), mask=part.is_null())
        assert pieces.decode_array(lists, PIECE_MODEL).to_pylist() == part.to_pylist()
        assert pieces.decode_array(lists.slice(1, 2), PIECE_MODEL).to_pylist() == part.to_pylist()[1:3]
    broken = pa.array([[vocabulary.byte_ids[0xC3]] * 2, None, []], pa.list_(pa.int32()))
    assert pieces.decode_array(broken, PIECE_MODEL).to_pylist() == ["\ufffd", None, ""]


def test_words_are_looked_up_once_a_chunk(monkeypatch):
    memory, seen = pieces._memory(PIECE_MODEL), []
    monkeypatch.setattr(memory, "learn", lambda words: seen.extend(words))
    pieces.encode_texts(["one two one two one two"] * 50, PIECE_MODEL)
    assert sorted(seen) == [" one", " two"]


@pytest.mark.parametrize("extra, pattern", [("", r"\n| +[^ \n]*|[^ \n]+"), ("a\nb", r" +[^ ]*|[^ ]+"), ("a b", r"(?s).+")])
def test_cuts_by_bytes(extra, pattern):
    import re

    import numpy as np

    made = {text: (n, -1.0) for n, text in enumerate(x for x in ("a", "b", " ", "\n", extra) if x)}
    v = pieces.Vocabulary(made, list(range(10, 266)), 266)
    for text in samples():
        data = np.frombuffer(text.encode(), np.uint8)
        new = v.cuts(data)
        new[:1] = True
        starts = np.flatnonzero(new).tolist()
        assert [bytes(data[a:b]).decode() for a, b in zip(starts, [*starts[1:], len(data)])] == re.findall(pattern, text)
