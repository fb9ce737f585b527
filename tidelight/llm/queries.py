"""The text operators over the given tables, with production parameters."""

from __future__ import annotations

import os
import string

from pyspark.sql import functions as F

from tidelight.llm import bilinear, fingerprints, importance, lines, mixing, neardup, passages, phrases, pieces, pii, quality, sharding, toxicity
from tidelight.llm.tables import table
from tidelight.plans.catalog import Catalog

PLANS = Catalog()
TOKENIZERS = os.environ.get("TIDELIGHT_TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
SHARDS = 24
DOMAIN_WEIGHTS = {"clean": 0.82, "poor": 0.09, "toxic": 0.09}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@PLANS.add()
def op1_personal_data(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(base) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.digest(base).cast("binary"), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans")
    )


@PLANS.add()
def op2_ring_shards(spark, sf_dir):
    placed = sharding.shard_by_ring(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard",
    )


@PLANS.add(f"""WITH held AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM held),
keyed AS (SELECT *, translate(trim(line, {_WHITE}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key
  FROM lines),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, s.first IS NOT NULL AND k.doc_id > s.first AS dropped FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op3_line_dedup(spark, sf_dir):
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def label_domain():
    """What a label says about a text: ``toxic``, else ``poor`` or ``clean`` by its quality."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")


@PLANS.add()
def op4_soft_mixing(spark, sf_dir):
    rates = mixing.fit_rates(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label_domain(), DOMAIN_WEIGHTS
    )
    posterior = [F.col("posterior")[name].alias(f"p_{name}") for name in DOMAIN_WEIGHTS]
    return rates.select("doc_id", "n_words", *posterior, "rate", "copies")


@PLANS.add()
def op5_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@PLANS.add()
def op6_repeated_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@PLANS.add()
def op7_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL, to="decoded")
    return back.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.size("ids").cast("long").alias("n_ids"), "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


@PLANS.add()
def op8_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@PLANS.add()
def op9_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


@PLANS.add()
def op10_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_LOWER = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')".format


def _phrases_sql(min_count: int, top: int) -> str:
    """Plain counting of all runs of up to five words."""
    ranks = range(1, 6)
    runs = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, {' || '.join(['w1', *(f"' ' || w{at}" for at in range(2, k + 1))])} AS phrase FROM ahead "
        f"WHERE w{k} IS NOT NULL"
        for k in ranks
    )
    leads = ", ".join(["w AS w1", *(f"lead(w, {at - 1}) OVER p AS w{at}" for at in range(2, 6))])
    parts = " UNION ALL ".join(
        f"SELECT lang, phrase, k, a, array_to_string(ws[1:{cut}], ' ') AS p1, array_to_string(ws[{cut + 1}:], ' ') AS p2, {cut} AS cut "
        f"FROM kept WHERE k > {cut}"
        for cut in range(1, 5)
    )
    inner = " UNION ALL ".join(
        f"SELECT lang, array_to_string(ws[{at}:{at + size - 1}], ' ') AS phrase, a FROM longer WHERE k > {size} AND k >= {at + size - 1}"
        for size in range(2, 5)
        for at in range(1, 5)
    )
    return f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array({_LOWER("coalesce(text, '')")},
  '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, regexp_split_to_array(piece, '[ \t]+') AS ws FROM pieces),
words AS (SELECT lang, id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM numbered),
ahead AS (SELECT lang, {leads} FROM words WHERE w <> '' WINDOW p AS (PARTITION BY id ORDER BY pos)),
every AS (SELECT lang, k, phrase, count(*) AS a FROM ({runs}) GROUP BY ALL HAVING k = 1 OR count(*) >= {min_count}),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM every WHERE k = 1 GROUP BY lang),
longer AS (SELECT *, string_split(phrase, ' ') AS ws FROM every WHERE k > 1),
above AS (SELECT lang, phrase, max(a) AS above FROM ({inner}) GROUP BY lang, phrase),
kept AS (SELECT longer.* FROM longer LEFT JOIN above USING (lang, phrase) WHERE above IS NULL OR 100 * above < 100 * a),
cuts AS ({parts}),
scored AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, cut,
  CAST((CAST(c.a AS HUGEINT) * n * 1000) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN every x ON x.lang = c.lang AND x.phrase = p1 JOIN every y ON y.lang = c.lang AND y.phrase = p2
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {top}"""


@PLANS.add(_phrases_sql(100, 2000))
def op11_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


_CRC_STEP = "if({0} & 1 = 1, xor({0} >> 1, 3988292384), {0} >> 1)".format
_CRC = "b"
for _ in range(8):
    _CRC = f"list_transform([{_CRC}], lambda c: {_CRC_STEP('c')})[1]"


@PLANS.add(f"""WITH steps AS (SELECT list_transform(range(256), lambda b: {_CRC}) AS steps),
texts AS (SELECT doc_id AS id, true AS own, {_LOWER("coalesce(text, '')")} AS text FROM documents
  UNION ALL SELECT item_id, false, {_LOWER("coalesce(text, '')")} FROM benchmark),
words AS (SELECT own, id, list_filter(regexp_split_to_array(text, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM texts),
features AS (SELECT own, id, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS feature FROM words),
distinct_features AS (SELECT DISTINCT feature, hex(encode(feature)) AS digits FROM features),
buckets AS (SELECT feature, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(digits) // 2),
    lambda b: CAST('0x' || substr(digits, CAST(2 * b + 1 AS INT), 2) AS BIGINT))),
    lambda crc, byte: xor(crc >> 8, steps[xor(crc & 255, byte) + 1]))) % 10000 AS bucket FROM distinct_features, steps),
counts AS (SELECT bucket, count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE NOT own) AS t
  FROM features JOIN buckets USING (feature) GROUP BY bucket),
sums AS (SELECT CAST(sum(s) AS DOUBLE) AS S_, CAST(sum(t) AS DOUBLE) AS T_ FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * (S_ + 10000)) / (CAST(s + 1 AS DOUBLE) * (T_ + 10000)))) AS BIGINT) AS gain
  FROM counts, sums),
weights AS (SELECT id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM features JOIN buckets USING (feature) JOIN gains USING (bucket) WHERE own GROUP BY id),
scored AS (SELECT w.id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= 20 AS ready,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || w.id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words w LEFT JOIN weights USING (id) WHERE own),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ready ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN ready AND place <= (SELECT count(*) FROM scored WHERE ready) * 25 // 100 THEN place END AS rank FROM ranked""")
def op12_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@PLANS.add()
def op13_bilinear(spark, sf_dir):
    return bilinear.score(table(spark, sf_dir, "documents"))
