"""Personal data, toxicity, mixing and fingerprints."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelight.llm import fingerprints, mixing, pii, toxicity
from tidelight.llm.queries import DOMAIN_WEIGHTS, label_domain, op1_personal_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".") if kind == "ip"),
                "card": 14 <= len(digits) <= 19 and total % 10 == 0, "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns(given):
    rng = random.Random(4)
    odd = ["".join(rng.choice("0123456789.@+- ()aZ_%é\n") for _ in range(300)) for _ in range(400)]
    odd += ["a@b@c.de", "x.y@a.b.c.", "@a.b", "a@.b", "4111 1111 1111 1111 12", "1.2.3.4.5.6.7.8", "0000255.1.1.1", "+1 (555) 123-4567."]
    for text in [r.text for r in given.collect()] + odd:
        assert pii.base_spans(text) == plain_spans(text), text[:80]


def test_long_runs_stay_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+(" * 100_000, "a@" * 100_000, "1 " * 150_000):
        pii.candidates(text)


def test_weak_votes_add_spans_and_keep_base_ones(spark, awkward, nothing):
    good = [(k, f"call me on tel 555-201-4{100 + k} or mail a{k}@b.org today") for k in range(30)]
    good += [(100 + k, f"phone +1 (555) 201-4{100 + k}, write to b{k} (at) c (dot) com") for k in range(30)]
    plain = [(200 + k, f"version {k}.2.3 of order 1234567812345678{k} is out") for k in range(30)]
    docs = spark.createDataFrame(good + plain, "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    assert [s.kind for s in rows[3]] == ["phone", "email"] and [s.base for s in rows[3]] == [False, True]
    assert [(s.kind, s.base) for s in rows[103]] == [("phone", True), ("email", False)]
    assert not any(not s.base for k in range(30) for s in rows[200 + k])
    assert len(pii.find_personal_data(awkward).collect()) == awkward.count()
    assert [len(r.spans) for r in pii.find_personal_data(awkward).where("doc_id = 12").collect()] == [1, 1]
    assert pii.find_personal_data(nothing).count() == 0


def test_the_digest_of_base_spans(spark, sf_dir):
    rows = {r.doc_id: r for r in op1_personal_data(spark, sf_dir).collect()}
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        base = plain_spans(doc.text)
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        got = rows[doc.doc_id]
        assert got.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (got.n_email, got.n_ip, got.n_card, got.n_phone) == tuple(sum(k == r for _, k, _ in base) for r in range(4))
        assert set(joined.split(",")) <= set(got.spans.split(","))


def test_expectation_maximisation_finds_the_bad_labeler():
    rng = np.random.default_rng(1)
    truth = rng.random(4_000) < 0.4
    right = [0.95, 0.9, 0.85, 0.5, 0.9]
    votes = np.stack([np.where(rng.random(4_000) < p, truth, ~truth) + 1 for p in right], 1)
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    p = pii.estimate(rows, np.zeros(len(rows), int), np.zeros(len(rows), bool), counts.astype(float))
    sides = {tuple(r): q for r, q in zip(rows.tolist(), p)}
    assert np.mean([(sides[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth)]) > 0.95
    assert abs(sides[(2, 2, 2, 1, 2)] - sides[(2, 2, 2, 2, 2)]) < 0.05


def toxic_tables(spark, n=600):
    rng = random.Random(9)
    common = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 6))) for _ in range(800)]
    bad = ["zzbad", "zzworse", "zzworst"]
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(30, 120))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(bad)
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    docs += [(n, None), (n + 1, ""), (n + 1, "")]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def area(truth, scores):
    order = np.argsort(np.argsort(scores))
    ones = truth == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_toxicity_of_held_out_texts(spark):
    docs, labels = toxic_tables(spark)
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert area(rows.toxic.to_numpy(), rows.score.to_numpy()) > 0.97
    assert (rows.predicted == rows.toxic).mean() > 0.9
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all()


def test_a_few_toxic_words_tell_in_long_texts(spark):
    rng = random.Random(11)
    texts, bad = [], ["zzbad", "zzworse", "zzfoul"]
    for k in range(500):
        # As many new pairs of rare words as in life: each text has its own way with them.
        words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(200, 900))]
        for _ in range(2 * (k % 5 == 0)):
            words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(500)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert area(rows.toxic.to_numpy(), rows.score.to_numpy()) > 0.97
    assert (rows.predicted == rows.toxic).mean() > 0.95
    got, _, peak = toxicity.fit(docs, labels).difference(pa.array(["zzbad w1 w2", "", None, "never-seen"]))
    assert peak[0] > 0 and peak[1:].tolist() == [0, 0, 0] and got[1:3].tolist() == [0, 0]


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    docs, labels = toxic_tables(spark, 200)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r.doc_id: r.score for r in toxicity.score(docs, x).collect()} for x in (labels, turned))
    assert one == two


def test_toxicity_of_awkward_rows(awkward, nothing, no_labels, spark):
    _, labels = toxic_tables(spark, 20)
    for docs in (awkward, nothing):
        for known in (labels, no_labels):
            rows = toxicity.score(docs, known).collect()
            assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)


def plain_ratios(texts, toxic, every):
    """Interpolated Kneser-Ney of both classes, straight from the definition."""
    cut = lambda text: [x for x in (v.lower().strip(toxicity._OUTER) for v in (text or "").split()) if x]
    runs, common = {0: set(), 1: set()}, Counter(x for text in every for x in cut(text))
    for text, y in zip(texts, toxic):
        words = ["", "", *cut(text)]
        runs[y] |= {tuple(words[at - 2 : at + 1]) for at in range(2, len(words))}
    pairs = {y: Counter((b, x) for _, b, x in runs[y]) for y in (0, 1)}
    kinds = {y: Counter(x for _, x in pairs[y]) for y in (0, 1)}
    known = set(kinds[0]) | set(kinds[1])
    everything = sum(common.values())

    def discount(counts):
        once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.5

    def chance(y, before, word):
        flat, steep, total = discount(kinds[y]), discount(pairs[y]), sum(kinds[y].values())
        last = (common[word] + 0.5) / (everything + 0.5 * (len(known) + 1) + 1) if word in known else 1 / (everything + 1)
        lower = max(kinds[y][word] - flat, 0) / total + flat * len(kinds[y]) / total * last
        after = [c for (b, _), c in pairs[y].items() if b == before]
        if not after:
            return lower
        return (max(pairs[y][before, word] - steep, 0) + steep * len(after) * lower) / sum(after)

    out = []
    for text in every:
        words = ["", *cut(text)]
        logs = [math.log(chance(1, *two) / chance(0, *two)) for two in zip(words, words[1:])]
        out.append(sum(logs) / (len(logs) + toxicity.PRIOR_WORDS))
    return out


def test_toxicity_equals_plain_kneser_ney(spark):
    docs, labels = toxic_tables(spark, 100)
    docs = docs.unionByName(spark.createDataFrame([(900, "Never seen, never heard zzbad (never) seen"), (901, " … ")], docs.schema))
    fitting, _ = toxicity._sample(docs, labels, 30, 9_000)
    sample = fitting.collect()
    assert 0 < len(sample) < 60 and {r.toxic for r in sample} == {0, 1}
    rows = docs.orderBy("doc_id").collect()
    expected = plain_ratios([r.text for r in sample], [r.toxic for r in sample], [r.text for r in rows])
    got = toxicity.score(docs, labels, 30, 9_000).orderBy("doc_id").collect()
    assert [r.llr for r in got] == pytest.approx(expected, abs=1e-9)


def mixed_tables(spark, n=900):
    rng = random.Random(2)
    pools = {"clean": "alpha beta gamma delta".split(), "poor": "junk spam rubbish".split(), "toxic": "zzbad zzworse".split()}
    docs, labels = [], []
    for k in range(n):
        kind = ("clean", "clean", "poor", "toxic")[k % 4]
        words = [rng.choice(pools[kind]) if rng.random() < 0.5 else f"w{rng.randint(0, 300)}" for _ in range(rng.randint(10, 60))]
        docs.append((k, " ".join(words), "m"))
        labels.append((k, int(kind != "poor"), int(kind == "toxic")))
    return spark.createDataFrame(docs, "doc_id long, text string, _c string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rates_meet_the_targets(spark):
    docs, labels = mixed_tables(spark)
    weights = {"clean": 0.6, "poor": 0.3, "toxic": 0.1}
    rows = mixing.fit_rates(docs, labels, label_domain(), weights).toPandas()
    use = rows.n_words * rows.rate
    totals = {d: float(sum(u * p[d] for u, p in zip(use, rows.posterior))) for d in weights}
    for d, share in weights.items():
        assert totals[d] / sum(totals.values()) == pytest.approx(share, abs=0.005)
    assert (rows.rate >= 0).all() and abs(rows.copies.mean() - rows.rate.mean()) < 0.1
    kinds = np.array(["clean", "clean", "poor", "toxic"])[rows.doc_id % 4]
    assert np.mean([max(p, key=p.get) == k for p, k in zip(rows.posterior, kinds)]) > 0.95


def test_rates_are_the_projected_gradient_ones(spark):
    rng = np.random.default_rng(3)
    n, p = rng.integers(1, 50, 40), rng.dirichlet([0.4] * 3, 40)
    known = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n_words long, posterior array<double>")
    weights = {"clean": 0.5, "poor": 0.3, "toxic": 0.2}
    slopes, totals = mixing.solve_rates(known, list(weights), weights, budget=float(n.sum()), rounds=30, tolerance=0, block=7)
    natural = (n[:, None] * p).sum(0)
    rate = np.ones(40)
    for _ in range(30):
        residual = (n[:, None] * p * rate[:, None]).sum(0) - n.sum() * np.array(list(weights.values()))
        rate = np.maximum(rate - p @ (residual / natural), 0)
    got = known.select(mixing.rate_column(F.col("posterior"), F.col("n_words"), slopes, None).alias("r")).toPandas().r
    assert np.allclose(np.sort(got), np.sort(rate), atol=1e-9)
    assert np.allclose([t[2] for t in totals.values()], (n[:, None] * p * rate[:, None]).sum(0))


def test_mixing_keeps_rows_and_columns(spark, awkward, nothing, no_labels):
    docs, labels = mixed_tables(spark, 200)
    out = mixing.mix_documents(docs, labels, label_domain(), DOMAIN_WEIGHTS, max_rate=1.0)
    assert out.columns == docs.columns and out.count() == out.select("doc_id").distinct().count()
    many = mixing.mix_documents(docs, labels, label_domain(), DOMAIN_WEIGHTS, budget=20_000.0)
    assert many.count() > docs.count()
    for known in (labels, no_labels):
        mixed = mixing.mix_documents(awkward, known, label_domain(), DOMAIN_WEIGHTS, max_rate=1.0)
        assert mixed.columns == awkward.columns and {r.doc_id for r in mixed.collect()} >= {4, 5, 6, 17}
    assert mixing.mix_documents(nothing, labels, label_domain(), DOMAIN_WEIGHTS).count() == 0


def test_sketches_recover_what_differs():
    rng = random.Random(1)
    for size in (0, 1, 5, 40, 300):
        first = [[rng.getrandbits(64) for _ in range(size)] for _ in range(20)]
        second = [x[: size // 2] + [rng.getrandbits(64) for _ in range(rng.randint(0, size))] for x in first]
        for (mine, yours), a, b in zip(fingerprints.differences(first, second, 2), first, second):
            assert set(mine) == set(a) - set(b) and set(yours) == set(b) - set(a)


def test_digests_differ_within_a_text():
    text = "\n".join(f"{a}{b}!" for _ in range(40) for a in "ABCDEF" for b in "ABCDEF") + "\nA!" * 500
    digests = fingerprints.paragraph_digests(text)
    assert len(digests) == len(set(digests)) == 40 * 36 + 500


def test_fingerprints_of_neighbours(given):
    rows = {r.doc_id: r.text for r in given.select("doc_id", "text").collect()}
    for ranges in (1, 7):
        got = fingerprints.fingerprint_documents(given, ranges).collect()
        assert sorted(r.doc_id for r in got) == sorted(rows)
        ids = sorted(rows, reverse=True)
        following = dict(zip(ids, ids[1:] + ids[:1]))
        for r in got:
            own, nxt = rows[r.doc_id], rows[following[r.doc_id]]
            half = len(own) // 2
            new = own[: len(own) - half] + nxt[:half]
            assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(own)
            for text, near in ((new, r.near_edited), (nxt, r.near_next)):
                a, b = (set(fingerprints.paragraph_digests(t)) for t in (own, text))
                assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    prints = {}
    for r in got:
        assert prints.setdefault(rows[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_fingerprints_of_awkward_rows(awkward, nothing, spark):
    got = fingerprints.fingerprint_documents(awkward, 4).collect()
    assert len(got) == awkward.count() and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    assert fingerprints.fingerprint_documents(nothing).count() == 0
    (one,) = fingerprints.fingerprint_documents(spark.createDataFrame([(3, "abcd")], "doc_id long, text string"), 5).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_rare_words_of_a_class_count(spark):
    docs, labels = toxic_tables(spark, 200)
    used = [r.doc_id for r in toxicity.training_rows(labels).where("toxic = 1 AND fold <> 4").orderBy("doc_id").limit(2).collect()]
    rare = docs.selectExpr("doc_id", f"CASE WHEN doc_id IN ({used[0]}, {used[1]}) THEN text || ' zzrare' ELSE text END AS text")
    model = toxicity.fit(rare, labels)
    seen, unseen = model.difference(pa.array(["zzrare", "zznever"]))[0]
    assert seen > unseen
