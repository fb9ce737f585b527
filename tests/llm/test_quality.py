import re
from collections import Counter

from pyspark.sql import functions as F

from tidelight.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {k + j for k, g in enumerate(grams) if g in twice for j in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def check(docs):
    texts = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *plain(r.text)) for r in texts), key=repr)
    got = quality.judge(docs).select("doc_id", *quality.MEASURES[:5]).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_measures_equal_a_plain_loop(given, awkward):
    check(given)
    check(awkward)


def test_verdicts(given, awkward, nothing):
    rows = quality.judge(given).collect()
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in rows)
    assert all(r.kept == (not r.base_failed and not r.host_rejected) for r in rows)
    assert not any(r.host_rejected for r in rows)
    assert quality.judge(nothing).count() == 0
    kept = quality.keep_documents(awkward)
    assert kept.columns == awkward.columns
    assert 11 not in [r.doc_id for r in kept.collect()] and quality.keep_documents(nothing).count() == 0


def hosts(spark):
    good = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(k, good + f" {k}", "good") for k in range(50)] + [(100 + k, "a b", "bad") for k in range(30)]
    rows += [(200, good + " own", "bad"), (300, "too short", "tiny"), (301, good + " tiny", "tiny")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_a_bad_host_takes_its_good_document_along(spark):
    rows = {r.doc_id: r for r in quality.judge(hosts(spark)).collect()}
    assert rows[200].host_rejected and not rows[200].kept and not rows[200].base_failed
    assert rows[301].kept and not rows[300].kept  # one failure of two says little about a host
    salted = quality.judge(hosts(spark), max_broadcast=0)
    assert {r.doc_id: r.kept for r in salted.collect()} == {k: r.kept for k, r in rows.items()}
    assert {r.doc_id for r in quality.keep_documents(hosts(spark)).collect()} == {k for k, r in rows.items() if r.kept}


def test_rates_are_shrunk(spark):
    rates = {(r.host, r.rule): r for r in quality.host_rates(quality.measure(hosts(spark))).collect()}
    bad, tiny = rates["bad", "base"], rates["tiny", "base"]
    overall = 31 / 83
    assert overall < bad.rate < bad.k / bad.n and overall < tiny.rate < 0.5
    assert hosts(spark).agg(F.count("*")).first()[0] == 83
