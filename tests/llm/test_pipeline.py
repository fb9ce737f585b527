import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelight.llm import mixing, pieces, quality
from tidelight.session import settle


def test_each_stage_acts_on_what_its_predecessor_kept(spark, given, sf_dir):
    docs = given
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf_dir))
        seen.append(docs)
        if name != "encode_pieces":
            assert docs.columns == given.columns
    good, lines, single, mixed, encoded = seen[1:]
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert ids[1] == {r.doc_id for r in quality.judge(given).where("kept").collect()}
    assert ids[2] == ids[1] and lines.where("n_chars <> length(text)").count() == 0
    assert ids[0] > ids[3] >= ids[4] == ids[5]
    assert encoded.where("NOT round_trip").count() == 0 and encoded.count() == len(ids[5])
    (row,) = encoded.limit(1).collect()
    assert pieces.encode_texts([row.text], corpus_pipeline.PIECE_MODEL)[0].tolist() == row.ids


@pytest.mark.parametrize("at", range(5))
def test_stages_take_awkward_and_empty_documents(spark, awkward, nothing, sf_dir, at):
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, awkward, sf_dir)
    assert 0 < out.count() <= awkward.count()
    if at < 4:
        assert out.columns == awkward.columns
    assert stage(spark, nothing, sf_dir).count() == 0


def test_the_registered_queries(spark):
    import __spark_entry__ as driver

    names = list(driver.queries())
    assert "pipeline" in names and [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert set(driver.oracle_sql()) <= set(names)


def test_mixing_sends_small_batches_to_python(spark, sf_dir, monkeypatch):
    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('some words ', 8000)").alias("text"))

    def sizes(docs, classifier):
        @F.arrow_udf("struct<n_words: long, posterior: array<double>>")
        def size(texts: pa.Array) -> pa.Array:
            return pa.array([{"n_words": texts.nbytes, "posterior": [1.0, 0.0, 0.0]}] * len(texts), pa.struct({"n_words": pa.int64(), "posterior": pa.list_(pa.float64())}))

        return size(F.col("text"))

    seen = []
    monkeypatch.setattr(mixing, "posterior_column", sizes)
    monkeypatch.setattr(mixing, "solve_rates", lambda known, *_: (seen.extend(r.n_words for r in known.collect()), ([], {}))[1])
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    out = dict(corpus_pipeline.STAGES)["mix_to_targets"](spark, docs, sf_dir)
    assert len(seen) == 300 and 0 < max(seen) < 6_000_000 and out.count() == 300
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
