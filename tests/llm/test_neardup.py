import inspect
import random

import numpy as np
import pyarrow as pa
import pytest

from tidelight import session
from tidelight.llm import neardup, passages
from tidelight.llm import words as w
from tidelight.llm.components import components


def roots(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    pairs = {
        "chain": [(k, k + 1) for k in range(120)], "star": [(500, k) for k in range(200)],
        "random": [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(7, 7), (8, 9), (9, 8)], "none": [],
    }[shape]
    links = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.class_id for r in components(links).collect()} == roots(pairs)


def variants(seed, words, copies, changes):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5_000)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(changes):
            text[rng.randrange(words)] = f"c{rng.randint(0, 10**6)}"
        yield " ".join(text)


def plain_classes(docs, idf, threshold=0.8):
    weighed = [neardup._weigh(pa.array([text or ""]), idf) for _, text in docs]
    pairs = [(i, i) for i, _ in docs]
    for a in range(len(docs)):
        for b in range(a):
            same = (docs[a][1] or "") == (docs[b][1] or "")
            if same or min(len(weighed[a][0]), len(weighed[b][0])) and neardup.weighted_jaccard(weighed[a], weighed[b]) >= threshold:
                pairs.append((docs[a][0], docs[b][0]))
    return roots(pairs)


def test_classes_equal_brute_force(spark):
    texts = [t for seed, (n, copies, changes) in enumerate([(300, 6, 3), (80, 30, 1), (200, 4, 0), (120, 5, 40), (3, 2, 0)]) for t in variants(seed, n, copies, changes)]
    rows = [(k * 3 + 1, text) for k, text in enumerate(texts)] + [(9_000, None), (9_001, ""), (9_002, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    idf = neardup.inverse_frequencies(docs)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert {k: r.class_id for k, r in got.items()} == plain_classes(rows, idf)
    sizes = [r.class_id for r in got.values()]
    assert all(r.class_size == sizes.count(r.class_id) for r in got.values())
    kept = sorted(r.doc_id for r in neardup.keep_first(docs).collect())
    assert kept == sorted({r.class_id for r in got.values()})


def test_a_large_group_of_different_near_copies_is_one_class(spark):
    rows = list(enumerate(variants(1, 150, 400, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = neardup.near_duplicates(docs).collect()
    assert {r.class_id for r in got} == {0}


def test_a_bucket_of_unlike_texts_is_compared_in_tiles(spark, monkeypatch):
    common = "one sentence that all of these texts repeat again and again. " * 14
    texts = [common + next(variants(k, 40, 1, 0)) for k in range(140)] + [common + t for t in variants(900, 40, 6, 1)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pairs, verified = [], neardup._verified
    monkeypatch.setattr(neardup, "_verified", lambda p, *rest: pairs.append(p.count()) or verified(p, *rest))
    monkeypatch.setattr(neardup, "BLOCK", 32, raising=False)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs, bands=8, rows=1).collect()}
    assert got == plain_classes(rows, neardup.inverse_frequencies(docs)) and 20 < len(set(got.values()))
    assert sum(pairs) <= 8 * len(rows)  # all pairs would be 10 585


def test_awkward_rows(awkward, nothing):
    got = neardup.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[12] == 12 and by_id[15] == 15
    kept = neardup.keep_first(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({r.class_id for r in got}) and ids.count(12) == 1 and 2 not in ids
    assert neardup.near_duplicates(nothing).count() == 0 and neardup.keep_first(nothing).count() == 0


def test_samples_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(2)
    shared, own = rng.integers(0, 2**44, 300).astype(np.uint64), rng.integers(0, 2**44, 200).astype(np.uint64)
    first, second = np.sort(np.concatenate([shared, own[:100]])), np.sort(np.concatenate([shared, own[100:]]))
    weight = lambda h: 1 + (h % np.uint64(7)).astype(float)
    truth = neardup.weighted_jaccard((first, weight(first)), (second, weight(second)))
    drawn = [neardup.samples(np.zeros(len(s), np.int64), s, weight(s), 600)[1][0] for s in (first, second)]
    assert abs((drawn[0] == drawn[1]).mean() - truth) < 0.06


def test_compact_windows_equal_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(200):
        n, least = int(rng.integers(1, 60)), int(rng.integers(2, 8))
        hashes = rng.integers(1, 15 if trial % 2 else 10**9, n).astype(np.uint64) * np.uint64(2)
        bounds = np.unique(np.concatenate([[0], rng.integers(0, n, 2)]))
        want = set()
        for low, high in zip(bounds, np.append(bounds[1:], n)):
            for c in range(low, high):
                l = r = c
                while l > low and hashes[l - 1] > hashes[c]:
                    l -= 1
                while r + 1 < high and hashes[r + 1] >= hashes[c]:
                    r += 1
                if r - l + 1 >= least:
                    want.add((int(l), int(c), int(r)))
        assert set(zip(*(x.tolist() for x in passages.compact_windows(hashes, bounds, least)))) == want


def test_repeated_passages(spark):
    (passage,) = variants(50, 70, 1, 0)
    near = passage.split(" ")
    near[10] = "changed"
    fillers = [next(variants(k, 150, 1, 0)) for k in range(60, 68)]
    texts = {k: f for k, f in enumerate(fillers)}
    texts[1] += " " + passage
    texts[3] = passage + " " + texts[3]
    texts[5] += " " + " ".join(near) + " the end"
    texts[6] += " " + " ".join(passage.split(" ")[:30])  # too short to count
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in got} | {r.other_id for r in got} == {1, 3, 5}
    assert roots((r.doc_id, r.other_id) for r in got) == {1: 1, 3: 1, 5: 1}
    for r in got:
        mine, yours = texts[r.doc_id][r.start : r.stop], texts[r.other_id][r.other_start : r.other_stop]
        assert r.words >= 50 and len(mine.split(" ")) == r.words and r.similarity >= 0.8
        if 5 not in (r.doc_id, r.other_id):
            assert mine == yours == passage


def test_every_exact_repeat_of_the_given_table_is_found(given):
    rows = given.select("doc_id", "text").orderBy("doc_id").collect()
    owner, tokens, _ = passages.text_tokens(pa.array([r.text for r in rows]))
    first, hashes = w.windows(owner, tokens, 46)
    holders = {}
    for row, value in zip(owner[first], hashes.tolist()):
        holders.setdefault(value, set()).add(rows[row].doc_id)
    want = set().union(*(h for h in holders.values() if len(h) > 1))
    got = passages.repeated_passages(given).collect()
    assert want <= {r.doc_id for r in got} | {r.other_id for r in got}


def test_passages_of_awkward_rows(awkward, nothing):
    got = passages.repeated_passages(awkward).collect()
    linked = {frozenset((r.doc_id, r.other_id)) for r in got}
    assert {x for pair in linked for x in pair} >= {1, 2, 15} and all(r.doc_id != r.other_id for r in got)
    assert passages.repeated_passages(nothing).count() == 0


def test_a_pair_behind_two_pivots_that_do_not_hold_the_passage_is_linked(spark):
    # All runs of five words of the passage also stand in texts 1 and 999, each in a context of its own.
    (passage,) = variants(70, 60, 1, 0)
    words = passage.split(" ")
    texts = {k: " ".join([next(variants(80 + k, 90, 1, 0)), passage, next(variants(180 + k, 90, 1, 0))]) for k in (50, 51)}
    for k in (1, 999):
        parts = [" ".join([next(variants(3_000 + 100 * k + at, 60, 1, 0)), *words[at : at + 12]]) for at in range(0, 56, 4)]
        texts[k] = " ".join([*parts, next(variants(9_000 + k, 60, 1, 0))])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = passages.repeated_passages(docs).collect()
    assert {frozenset((r.doc_id, r.other_id)) for r in got} == {frozenset((50, 51))}
    for r in got:
        assert texts[r.doc_id][r.start : r.stop] == texts[r.other_id][r.other_start : r.other_stop] == passage


def test_every_occurrence_in_a_text_is_reported(spark):
    (passage,) = variants(71, 60, 1, 0)
    words = passage.split(" ")
    filler = lambda k, n=90: next(variants(500 + k, n, 1, 0))
    # The runs of five words of the passage, each earlier in a context of its own.
    apart = " ".join(" ".join([filler(20 + at, 60), *words[at : at + 12]]) for at in range(0, 56, 4))
    texts = {
        1: " ".join([filler(1), passage, filler(2)]), 2: " ".join([filler(3), passage, filler(4, 200), passage, filler(5)]),
        3: " ".join([apart, filler(6), passage, filler(7)]),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    places = set()
    for r in passages.repeated_passages(docs).collect():
        assert texts[r.doc_id][r.start : r.stop] == texts[r.other_id][r.other_start : r.other_stop] == passage
        places |= {(r.doc_id, r.start), (r.other_id, r.other_start)}
    second = texts[2].rindex(passage)
    assert places == {(k, text.index(passage)) for k, text in texts.items()} | {(2, second)}


@pytest.mark.parametrize("big", [512, 16])
def test_a_short_line_in_many_contexts_is_not_compared_in_vain(spark, monkeypatch, big):
    # Pairs of near copies, each in a context of its own, and one line of 26 words that all texts hold.
    (line,) = variants(90, 26, 1, 0)
    rows = []
    for k in range(40):
        before, after = next(variants(20_000 + k, 60, 1, 0)), next(variants(30_000 + k, 60, 1, 0))
        rows += [(2 * k, f"{before} {line} {after}"), (2 * k + 1, f"{before} {line} {after} changed {k}")]
    compared, verified = [], passages._verified

    def counted(regions, *rest):
        compared.append(regions.count())
        return verified(regions, *rest)

    monkeypatch.setattr(passages, "_verified", counted)
    monkeypatch.setattr(passages, "BIG", big, raising=False)
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {frozenset((r.doc_id, r.other_id)) for r in got} == {frozenset((2 * k, 2 * k + 1)) for k in range(40)}
    assert sum(compared) < 500, compared


def test_similar_stretches_share_one_of_their_first_tokens():
    rng = np.random.default_rng(5)
    late = rng.integers(1, 2**63, 500, dtype=np.uint64)
    for _ in range(200):
        shared = rng.choice(late, 37, replace=False) if rng.random() < 0.3 else rng.integers(1, 2**63, 37, dtype=np.uint64)
        zones = []
        for _ in range(2):
            zone = np.concatenate([shared, rng.integers(1, 2**63, 54, dtype=np.uint64)])
            zone[:46] = rng.permutation(zone[:46])
            zones.append(passages.first_of_stretches(zone, late, 46, 10))
        assert len(np.intersect1d(*zones))


def test_both_runs_with_more_occurrences_on_either_side():
    once = np.arange(100, 160).astype(np.uint64)
    twice = np.concatenate([once, np.arange(1_000, 1_030).astype(np.uint64), once])
    assert {x[:4] for x in passages.both_runs(once, twice, 46, 0.8)} == {(0, 59, 0, 59), (0, 59, 90, 149)}
    assert {x[:4] for x in passages.both_runs(twice, once, 46, 0.8)} == {(0, 59, 0, 59), (90, 149, 0, 59)}


def test_runs_of_different_tokens_are_those_of_the_general_way(monkeypatch):
    rng = np.random.default_rng(8)
    pairs = []
    for _ in range(60):
        mine = rng.choice(5_000, rng.integers(50, 300), replace=False).astype(np.uint64)
        yours = mine.copy()
        for at in rng.integers(0, len(mine), rng.integers(0, 9)):
            yours[at : at + 5] = rng.integers(10_000, 2**40, len(yours[at : at + 5]))
        cut = int(rng.integers(0, len(yours)))
        pairs.append((mine, np.concatenate([yours[cut:], rng.integers(10_000, 2**40, 20).astype(np.uint64), yours[:cut]])))
    fast = [passages.both_runs(a, b, 46, 0.8) for a, b in pairs]
    monkeypatch.setattr(passages, "_all_differ", lambda values: False)
    assert fast == [passages.both_runs(a, b, 46, 0.8) for a, b in pairs] and sum(map(bool, fast)) > 20


def test_a_star_of_edits_that_are_similar_to_the_base_only(spark, monkeypatch):
    # One bucket of all texts, so that only the choice of pairs counts.
    def one_bucket(owner, hashes, weights, count):
        rows = np.unique(owner)
        return rows, np.zeros((len(rows), count), np.uint64)

    monkeypatch.setattr(neardup, "samples", one_bucket)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(300)]
    rows = [(500, " ".join(base))]
    for k in range(1_000):
        text = list(base)
        at = rng.randrange(280)
        text[at : at + 20] = [f"c{k}_{n}" for n in range(20)]
        rows.append((k if k < 500 else k + 1, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    idf = neardup.inverse_frequencies(docs)
    weighed = {k: neardup._weigh(pa.array([text]), idf) for k, text in rows}
    assert all(neardup.weighted_jaccard(weighed[500], other) >= 0.8 for other in weighed.values())
    assert sum(neardup.weighted_jaccard(weighed[0], other) >= 0.8 for other in weighed.values()) < 500
    assert {r.class_id for r in neardup.near_duplicates(docs).collect()} == {0}


def test_many_pairs_at_once_give_the_runs_of_each():
    rng = np.random.default_rng(3)
    pairs = []
    for k in range(400):
        mine = rng.choice(2**39, rng.integers(40, 260), replace=False).astype(np.uint64)
        yours = mine.copy()
        for at in rng.integers(0, len(mine), rng.integers(0, 9)):
            yours[at : at + 5] = rng.integers(2**39, 2**40, len(yours[at : at + 5]))
        cut, more = int(rng.integers(0, len(mine))), rng.integers(1, 2**40, rng.integers(1, 20)).astype(np.uint64)
        yours = [yours, np.concatenate([yours[cut:], more, yours[:cut]]), np.concatenate([yours[:cut], more, yours[cut:]]), np.tile(yours, 2), yours[:0]][k % 5]
        pairs.append((mine, yours) if rng.random() < 0.8 else (yours, mine))
    sides = [np.concatenate(x) for x in zip(*pairs)]
    begins = [np.concatenate([[0], np.cumsum([len(pair[side]) for pair in pairs])]) for side in (0, 1)]
    got = [set() for _ in pairs]
    for row, *run in zip(*(x.tolist() for x in passages.runs_of_pairs(sides[0], begins[0], sides[1], begins[1], 46, 0.8))):
        got[row].add(tuple(run))
    assert got == [set(passages.both_runs(a, b, 46, 0.8)) for a, b in pairs] and sum(map(len, got)) > 200


def test_the_zones_of_a_passage_share_what_it_cannot_lack():
    missing, off = passages.lacking(46, 0.8)
    rng, seen = np.random.default_rng(6), 0
    while seen < 300:
        mine = rng.choice(2**40, rng.integers(46, 77), replace=False).astype(np.uint64)
        yours = mine.copy()
        for _ in range(rng.integers(1, 3)):  # words that are changed, left out or added in the middle
            at, add = int(rng.integers(len(mine) // 3, len(mine) // 3 * 2)), rng.integers(2**40, 2**41, rng.integers(1, 13)).astype(np.uint64)
            yours = np.concatenate([yours[:at], add, yours[at + rng.integers(0, 10) :]])
        runs = passages.matching_runs(mine, yours, 46, 0.8)
        if not runs or runs[0][0] > 0 or runs[0][1] < len(mine) - 1:
            continue
        token = int(rng.integers(0, len(mine)))
        key = int(mine[token])
        if key not in yours:
            continue
        seen += 1
        zones = [passages._zone(x, x.astype(np.int64), key, 0, len(x) - 1, 46, off - missing)[0] for x in (mine, yours)]
        assert len(np.intersect1d(*zones)) >= 46 - missing


def test_two_of_the_functions_agree_on_nearly_all_passages_of_least_similarity():
    options = {name: p.default for name, p in inspect.signature(passages.repeated_passages).parameters.items()}
    functions, enough = options["functions"], options["enough"]
    rng, agree = np.random.default_rng(11), []
    for _ in range(3_000):
        both = rng.integers(1, 2**40, 46).astype(np.uint64)
        mine, yours = both, both.copy()
        at = int(rng.integers(0, 42))
        yours[at : at + 5] = rng.integers(1, 2**40, 5)  # 41 of 51 tokens
        least = [[passages._hashed(x, f).min() for f in range(functions)] for x in (mine, yours)]
        agree.append(sum(a == b for a, b in zip(*least)) >= enough)
    assert np.mean(agree) >= 0.99


def test_texts_meet_the_same_pivots_under_every_token(spark):
    rows = [(f, key, doc, 10 * doc + 7 * f, 10 * doc + 7 * f + 60, True, 0) for f, key in ((0, 5), (1, -3), (2, 9)) for doc in range(100)]
    held = spark.createDataFrame(rows, f"{passages._WINDOW}, open boolean, sub long")
    chosen = {}
    for r in passages._pivots(held, 1).collect():
        chosen.setdefault(r.f, set()).add(r.doc)
    assert chosen[0] == chosen[1] == chosen[2] and 2 <= len(chosen[0]) <= passages.SPREAD


def test_tables_of_the_rounds_are_removed(spark, tmp_path, monkeypatch):
    # A token whose first and last text do not hold the passage, so that there are several rounds.
    (passage,) = variants(70, 60, 1, 0)
    texts = {k: " ".join([next(variants(80 + k, 90, 1, 0)), passage, next(variants(180 + k, 90, 1, 0))]) for k in (50, 51)}
    for k in (1, 999):
        parts = [" ".join([next(variants(3_000 + 100 * k + at, 60, 1, 0)), *passage.split(" ")[at : at + 12]]) for at in range(0, 56, 4)]
        texts[k] = " ".join([*parts, next(variants(9_000 + k, 60, 1, 0))])
    monkeypatch.setattr(session, "_shared_folder", lambda spark: str(tmp_path))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    got = passages.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert len(list(tmp_path.iterdir())) == 2  # the runs, and where they lie in the texts
    assert {frozenset((r.doc_id, r.other_id)) for r in got.collect()} == {frozenset((50, 51))} and spark.conf.get(key) == before
    with pytest.raises(ValueError):
        spark.range(1).write.parquet(f"{tmp_path}/given")
        session.discard(spark.read.parquet(f"{tmp_path}/given"))
    assert spark.read.parquet(f"{tmp_path}/given").count() == 1
