"""Phrases, importance resampling and the log-bilinear model."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference
from conftest import prose
from pyspark.sql import functions as F

from tidelight.llm import bilinear, importance, phrases
from tidelight.llm.grams import byte_classes, cut_words
from tidelight.llm.queries import PLANS


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_phrases", "op12_importance"])
def test_the_sql_gives_the_same_rows(name, spark, sf_dir):
    assert difference(spark, connect(sf_dir), PLANS.entries[name].plan, PLANS.entries[name].sql, sf_dir) is None


def test_words_are_cut_as_the_patterns_say(given):
    rng = random.Random(3)
    odd = ["".join(rng.choice("aZé日. ,\t\n;\x7f\r\x0b9-") for _ in range(rng.randrange(80))) for _ in range(200)]
    texts = [r.text for r in given.limit(60).collect()] + odd + ["", None, " ", "a", ".", "x" * 100_000]
    for classes, piece, word in (
        (phrases.PIECES, r"[.,;:!?\x0A-\x0D]", r"[^\x20\x09]+"), (importance.APART, None, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
        (bilinear.WHITE, None, r"[^\x20\x09-\x0D]+"),
    ):
        plain = [
            (row, at, x) for row, text in enumerate(texts)
            for at, part in enumerate(re.split(piece, lower(text)) if piece else [lower(text)]) for x in re.findall(word, part)
        ]
        got = cut_words(pa.array(texts), classes)
        assert got.distinct.take(pa.array(got.code)).to_pylist() == [x for _, _, x in plain]
        assert got.owner.tolist() == [row for row, _, _ in plain]
        same = [a[:2] == b[:2] for a, b in zip(plain, plain[1:])]
        assert (got.piece[1:] == got.piece[:-1]).tolist() == same
    assert len(cut_words(pa.array([], pa.string()), byte_classes(b" "))) == 0


def plain_collocations(rows, min_count, top):
    by_lang = {}
    for lang, text in rows:
        counts = by_lang.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            counts.update(tuple(ws[i : i + k]) for k in range(1, 6) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in by_lang.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        absorbed = {
            p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= f[p[i : i + k]]
        }
        found = []
        for p, a in candidates.items():
            if p not in absorbed:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def test_phrases_equal_plain_counting_whatever_the_sample(spark, awkward, nothing):
    rng = random.Random(8)
    vocab = [f"w{n}" for n in range(30)] + ["é", "日本", "A", "zz"]
    rows = [(n, rng.choice(["en", None, "fr"]), " ".join(rng.choice(vocab) + rng.choice(["", "", "", ".", "\n"]) for _ in range(200)), "x") for n in range(60)]
    rows += [(100, "en", "run " * 3_000, "x"), (101, "en", None, "x"), (102, "de", "", "x")] + [(200 + n, "en", "the very same passage of text", "x") for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, phrase string").repartition(4)
    plain = plain_collocations([(r[1], r[2]) for r in rows], 20, 50)
    for share, slack, bits in ((6, 3.0, 20), (2, 0.0, 20), (1000, 3.0, 20), (6, 3.0, 7)):
        got = phrases.collocations(docs, min_count=20, top=50, share=share, slack=slack, map_bits=bits)
        assert sorted(tuple(r) for r in got.collect()) == plain
    # A sample that shows next to nothing: all phrases are failures of the border.
    _, _, passes = phrases.frequent_phrases(docs, min_count=20, share=1000, map_bits=20)
    assert passes == 2
    held = [(r.lang, r.text) for r in awkward.collect()]
    got = phrases.collocations(awkward, min_count=3, top=2000)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(held, 3, 2000)
    assert phrases.collocations(nothing).count() == 0


def test_rare_phrases_are_not_shuffled_as_texts(spark, monkeypatch):
    rng = random.Random(13)
    rows = [(n, rng.choice(["en", None]), " ".join(f"w{rng.randrange(40)}" for _ in range(300))) for n in range(30)]
    rows += [(100 + n, "en", "w1 w2 w3 w4 w5 w6") for n in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    plain = plain_collocations([r[1:] for r in rows], 20, 50)
    named, whole = [], phrases.count_phrases

    def watched(docs, wanted, counted=None, among=None):
        out = whole(docs, wanted, counted, among)
        if counted is None:
            named.append((out.where("n < 20").count(), whole(docs, wanted).where("n < 20").count()))
        return out

    monkeypatch.setattr(phrases, "count_phrases", watched)
    assert sorted(tuple(r) for r in phrases.collocations(docs, min_count=20, top=50, map_bits=20).collect()) == plain
    # Keys of few bits, which many phrases share, change no result.
    monkeypatch.setattr(phrases, "_short", lambda keys: keys >> phrases.np.uint64(58))
    assert sorted(tuple(r) for r in phrases.collocations(docs, min_count=20, top=50, map_bits=20).collect()) == plain
    (rare, all_rare), (rare_shared, _) = named
    assert rare * 20 < all_rare and rare_shared > rare


def test_phrase_scores_beyond_64_bits(spark):
    """The decimal expression of the score, at counts that no test table has."""
    wide = "cast(cast({} AS decimal(19, 0)) * cast({} AS decimal(19, 0)) AS decimal(38, 0))".format
    a, n, l, r = 10**12 + 7, 10**16 + 3, 3 * 10**12, 5 * 10**12
    row = spark.sql(f"SELECT cast({wide(f'{a}L', f'{n}L')} * 1000 AS decimal(38, 0)) div {wide(f'{l}L', f'{r}L')} AS s").first()
    assert row.s == 1000 * a * n // (l * r)


def plain_resample(docs, target, percent=25, buckets=10_000):
    def feats(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return len(ws), [zlib.crc32(x.encode()) % buckets for x in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]

    s, t = (Counter(b for _, text in side for b in feats(text)[1]) for side in (docs, target))
    all_s, all_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    scored = []
    for doc_id, text in docs:
        words, found = feats(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    ready = sorted((x for x in scored if x[4] >= 20), key=lambda x: (-x[3], 2**63 if x[0] is None else x[0], x[2], x[1]))
    drawn = ready[: percent * len(ready) // 100]
    out = [(*x[:4], rank) for rank, x in enumerate(drawn, 1)]
    return sorted(out + [(*x[:4], None) for x in [*ready[len(drawn) :], *(x for x in scored if x[4] < 20)]], key=repr)


@pytest.mark.parametrize("percent", [25, 100])
def test_resampling_equals_a_plain_draw(spark, awkward, nothing, percent):
    target = [(n, prose(50 + n, 40)) for n in range(20)]
    bench = spark.createDataFrame(target, "item_id long, text string")
    got = importance.resample(awkward, bench, percent=percent, segments=3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_resample([(r.doc_id, r.text) for r in awkward.collect()], target, percent)
    assert importance.resample(nothing, bench).count() == 0
    assert importance.resample(awkward, bench.limit(0)).count() == awkward.count()


def test_ranks_are_exact_with_equal_keys_and_few_runs(spark):
    rows = spark.range(20_000, numPartitions=7).select((F.col("id") * 7919 % 13).alias("a"), "id", F.lit(1).alias("rank_"))
    for segments in (1, 5, 64):
        got = importance.ranked(rows, ["a", "id"], segments, per_run=8).orderBy("rank").collect()
        assert [r["rank"] for r in got] == list(range(1, 20_001))
        assert [(r.a, r.id) for r in got] == sorted((n * 7919 % 13, n) for n in range(20_000))


def test_joined_checksums():
    rng = random.Random(1)
    first = [rng.randbytes(rng.randrange(30)) for _ in range(300)]
    second = [rng.randbytes(rng.choice([0, 1, 5, 70_000]) if n < 20 else rng.randrange(40)) for n in range(300)]
    got = importance.join_crc(
        np.array([zlib.crc32(x) for x in first], np.uint32), np.array([zlib.crc32(x) for x in second], np.uint32), np.array([len(x) for x in second])
    )
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(first, second)]


SMALL = bilinear.Settings(symbols=16, classes=8, dims=8, noise=8, batch=64, looked_up=40)


def plain_counts(rows):
    tokens = [(d, re.findall(r"[^\x20\x09-\x0D]+", lower(text))) for d, text in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in tokens]
    c = Counter(x for (_, ws), out in zip(tokens, held) if not out for x in [*ws, None])
    n, v = c.total(), len(c)
    return sorted(
        ((d, out, len(ws) + 1, sum(x in c for x in [*ws, None]), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in [*ws, None]), 6))
         for (d, ws), out in zip(tokens, held)), key=repr,
    )


def test_base_scores_equal_plain_counting(spark, awkward, nothing, given):
    for docs in (awkward, given):
        for settings in (SMALL, bilinear.Settings()):
            got = bilinear.score(docs, settings).collect()
            plain = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
            assert sorted(plain, key=repr) == plain_counts([(r.doc_id, r.text) for r in docs.collect()])
            assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert bilinear.score(nothing, SMALL).count() == 0


def test_probabilities_of_all_words_sum_to_one(spark, given):
    """In a context of two words, over every word of the table and one unknown word of each class."""
    counts = bilinear.token_counts(given).cache()
    vocab = bilinear.vocabulary(counts, SMALL)
    model = bilinear.train(bilinear.encode(given, vocab).cache(), vocab)
    context = np.tile([3, 7], (SMALL.all_symbols, 1))
    logs = model.log_probabilities(context, np.arange(SMALL.all_symbols))
    assert abs(np.exp(logs).sum() - 1) < 1e-5
    plain = model.predict(context[:1])[0] @ model.target.T + model.bias
    assert np.allclose(logs, plain - np.log(np.exp(plain).sum()), atol=1e-4)
    top = set(vocab.words[: vocab.end].to_pylist())
    rest = [(r.word, r.n) for r in counts.collect() if r.word and r.word not in top]
    classes = bilinear.ending_class(pa.array([word for word, _ in rest]), SMALL.classes)
    for at in range(SMALL.classes):
        inside = [n for (_, n), c in zip(rest, classes) if c == at]
        assert (sum(inside), len(inside)) == (vocab.class_tokens[at], vocab.class_distinct[at])
        total = sum((n + 1) / (vocab.class_tokens[at] + vocab.class_distinct[at] + 1) for n in inside)
        assert abs(total + 1 / (vocab.class_tokens[at] + vocab.class_distinct[at] + 1) - 1) < 1e-9


def test_scores_equal_a_plain_walk_through_the_text(spark, given):
    counts = bilinear.token_counts(given).cache()
    vocab = bilinear.vocabulary(counts, SMALL)
    encoded = bilinear.encode(given, vocab).cache()
    model = bilinear.train(encoded, vocab)
    n = {r.word: r.n for r in counts.collect()}
    top = {word: at for at, word in enumerate(vocab.words[: vocab.end].to_pylist())}
    got = {r.doc_id: r.score for r in bilinear.score(given, SMALL).collect()}
    for row in given.limit(15).collect():
        total, before = 0.0, [SMALL.all_symbols, SMALL.all_symbols]
        for word in [*re.findall(r"[^\x20\x09-\x0D]+", lower(row.text)), None]:
            at = bilinear.ending_class(pa.array([word or ""]), SMALL.classes)[0]
            symbol = vocab.end if word is None else top.get(word, SMALL.symbols + at)
            total += model.log_probabilities(np.array([before]), np.array([symbol]))[0] / math.log(10)
            if symbol >= SMALL.symbols:
                total += math.log10((n.get(word, 0) + 1) / (vocab.class_tokens[at] + vocab.class_distinct[at] + 1))
            before = [symbol, before[0]]
        assert abs(total - got[row.doc_id]) < 1e-3 * abs(total)


def test_the_model_beats_the_counts_on_held_out_texts(spark, nothing):
    rng = random.Random(2)
    words = [f"w{n}" for n in range(40)]
    follow = {word: rng.sample(words, 3) for word in words}

    def walk():
        out = [rng.choice(words)]
        while len(out) < 60:
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    docs = spark.createDataFrame([(n, walk()) for n in range(2_000)], "doc_id long, text string").repartition(2)
    settings = replace(bilinear.Settings(), symbols=64, classes=4)
    row = bilinear.score(docs, settings).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert row[0] / row[2] > row[1] / row[2] + 0.5  # log10 per token; log10(40) - log10(3) would be 1.12
