"""Quality rules, judged for documents and for their hosts.

Each document is measured by itself. Rule failures are then summed per host, each rule's failure rates over all hosts
give a beta prior (by moments), and a host whose shrunk rate of some rule is above the limit is rejected with
everything it holds. Hosts of few documents stay near the common rate.

* A null text has no words. A null host is one host of its own, ``''``. An empty table gives no rows.
* Ties: a rate equal to the limit passes. Repeated rows are judged one by one, each counting for its host.
* Other columns are not read by :func:`measure`; in :func:`keep_documents` they pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.llm import words as w
from tidelight.llm.tables import fresh
from tidelight.session import settle

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SHAPE = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def _measure(texts: pa.Array) -> list[np.ndarray]:
    rows = len(texts)
    texts = w.whole(texts)
    owner, found = w.split_words(texts)
    codes, _ = w.encode(found)
    n_words = w.per_text(owner, None, rows)
    word_chars = w.per_text(owner, pc.utf8_length(found).to_numpy(zero_copy_only=False), rows)

    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: rows + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    symbols = np.flatnonzero(_SYMBOL[data[: offsets[-1]]])
    n_symbols = np.diff(np.searchsorted(symbols, offsets))

    line_owner, lines = w.split_lines(texts)
    worded = pc.not_equal(pc.ascii_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
    line_codes, _ = w.encode(lines)
    keys = (line_owner << 32 | line_codes)[worded]
    distinct = np.unique(keys)
    n_lines = w.per_text(line_owner[worded], None, rows)
    n_dup_lines = n_lines - w.per_text(distinct >> 32, None, rows)

    first, hashes = w.windows(owner, w.mix(codes + 1), WINDOW)
    with np.errstate(over="ignore"):
        keys = w.mix(hashes + w.mix(owner[first].astype(np.uint64)))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    n_repeat = np.zeros(rows, np.int64)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        starts = first[twice[at] == keys]
        cover = np.zeros(len(codes) + 1, np.int64)
        cover[starts] += 1
        cover[starts + WINDOW] -= 1
        n_repeat = w.per_text(owner[np.cumsum(cover)[:-1] > 0], None, rows)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat, n_lines]


@F.arrow_udf(_SHAPE)
def measures(texts: pa.Array) -> pa.Array:
    parts = [_measure(part) for _, part in w.chunks(texts)]
    columns = [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], MEASURES)


def base_failed(m: Column) -> Column:
    """Too few words, or too many of them in windows that repeat."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def rules(m: Column) -> dict[str, Column]:
    """What counts against a host, by name."""
    return {
        "base": base_failed(m),
        "symbols": 10 * m["n_symbols"] > 5 * m["n_words"],
        "lines": 10 * m["n_dup_lines"] > 3 * m["n_lines"],
        "lengths": (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
    }


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, ``host`` and the struct ``m`` of measures."""
    return docs.select("doc_id", F.coalesce(F.col(host), F.lit("")).alias("host"), measures("text").alias("m"))


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host and rule: documents ``n``, failures ``k`` and the shrunk rate ``rate``.

    Prior: with m the rate over all documents and v the variance of the hosts' rates beyond what chance explains, the
    prior weighs like m(1 - m)/v - 1 documents, from 1 to a million.
    """
    names = list(rules(F.col("m")))
    per_host = measured.groupBy("host").agg(
        F.count("*").alias("n"), *(F.sum(rule.cast("long")).alias(name) for name, rule in rules(F.col("m")).items())
    )
    per_rule = settle(per_host.select("host", "n", F.stack(
        F.lit(len(names)), *(part for name in names for part in (F.lit(name), F.col(name)))
    ).alias("rule", "k")))
    overall = per_rule.groupBy("rule").agg(
        (F.sum("k") / F.sum("n")).alias("mean"), F.sum("n").alias("docs"), F.count("*").alias("hosts"),
        (F.sum(F.col("k") * F.col("k") / F.col("n"))).alias("squares"),
    )
    mean = F.col("mean")
    spread = F.col("squares") / F.col("docs") - mean * mean - mean * (1 - mean) * F.col("hosts") / F.col("docs")
    weight = F.when(spread > 0, F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0)), F.lit(1e6)))
    prior = overall.select("rule", "mean", F.coalesce(weight, F.lit(1e6)).alias("weight"))
    return per_rule.join(F.broadcast(prior), "rule").select(  # one row per rule
        "host", "rule", "n", "k", ((F.col("k") + mean * F.col("weight")) / (F.col("n") + F.col("weight"))).alias("rate")
    )


def _without_hosts(df: DataFrame, host: Column, rejected: DataFrame, flag: str, salts: int,
                   max_broadcast: int) -> DataFrame:
    """``df`` with the boolean ``flag``; one host may hold any share of the rows."""
    name, hit, salted = fresh(df, "_host"), fresh(df, "_hit"), fresh(df, "_salt")
    marked = rejected.select(F.col("host").alias(name), F.lit(True).alias(hit))
    if rejected.limit(max_broadcast + 1).count() <= max_broadcast:
        joined = df.join(F.broadcast(marked), host == F.col(name), "left")
    else:
        spread = marked.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(salted))
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
        joined = df.join(spread, (host == F.col(name)) & (salt == F.col(salted)), "left").drop(salted)
    return joined.withColumn(flag, F.col(hit).isNotNull()).drop(name, hit)


def rejected_hosts(measured: DataFrame, max_rate: float = 0.5) -> DataFrame:
    return settle(host_rates(measured).where(F.col("rate") > max_rate).select("host").distinct())


def judge(docs: DataFrame, host: str = "source", max_rate: float = 0.5, salts: int = 64,
          max_broadcast: int = 100_000) -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``host_rejected`` and ``kept``."""
    measured = settle(measure(docs, host))
    out = _without_hosts(measured, F.col("host"), rejected_hosts(measured, max_rate), "bad_host", salts, max_broadcast)
    failed = base_failed(F.col("m"))
    return out.select(
        "doc_id", *(F.col("m")[name].alias(name) for name in MEASURES), failed.alias("base_failed"),
        F.col("bad_host").alias("host_rejected"), (~failed & ~F.col("bad_host")).alias("kept"),
    )


def keep_documents(docs: DataFrame, host: str = "source", max_rate: float = 0.5, salts: int = 64,
                   max_broadcast: int = 100_000) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they had.

    Texts are measured twice instead of being written or shuffled.
    """
    rejected = rejected_hosts(settle(measure(docs, host)), max_rate)
    m, flag = fresh(docs, "_m"), fresh(docs, "_bad")
    out = docs.withColumn(m, measures("text")).where(~base_failed(F.col(m)))
    out = _without_hosts(out, F.coalesce(F.col(host), F.lit("")), rejected, flag, salts, max_broadcast)
    return out.where(~F.col(flag)).select(*(F.col(f"`{c}`") for c in docs.columns))
