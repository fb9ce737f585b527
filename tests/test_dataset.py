import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelight.functions.scoring import best_class, linear_model, model_at, score, size_error
from tidelight.operators import dataset, training
from tidelight.operators.batches import after_warmup, bench_summary
from tidelight.operators.outcomes import batch_score


def rows_of(spark, counts):
    """``counts`` maps (split, class) to a number of rows."""
    rows = [(f"{s}/{c}/{n}", s, c) for (s, c), k in counts.items() for n in range(k)]
    return spark.createDataFrame(rows, "sourcePath string, split string, labelId int")


def counts_of(df):
    return {(r.split, r.labelId): r.images for r in dataset.split_class_counts(df).collect()}


BASE = {("val", 0): 8, ("val", 1): 8, ("train", 0): 120, ("train", 1): 700, ("train", 2): 130, ("test", 2): 9}


def test_missing_counts_of_expected_classes(spark):
    need = {r.labelId: r.missing for r in dataset.val_missing(rows_of(spark, BASE)).collect()}
    assert need == {0: 92, 1: 92, 2: 100}
    seen = dataset.val_missing(rows_of(spark, {("val", 5): 3}), 2, classes=None).collect()
    assert [(r.labelId, r.missing) for r in seen] == [(5, 0)]


@pytest.mark.parametrize("classes", [(0, 1, 2), None])
def test_rebalance_fills_val_from_train_only(spark, classes):
    df = rows_of(spark, BASE)
    done = dataset.rebalance_validation(df, 100, classes=classes)
    assert counts_of(done) == {
        ("val", 0): 100, ("val", 1): 100, ("val", 2): 100,
        ("train", 0): 28, ("train", 1): 608, ("train", 2): 30, ("test", 2): 9,
    }
    assert done.columns == df.columns
    again = dataset.rebalance_validation(df.repartition(9), 100, classes=classes)
    assert sorted(done.collect()) == sorted(again.collect())


def test_chosen_rows_are_the_smallest_hashes(spark):
    df = rows_of(spark, {("train", 1): 500})
    need = spark.createDataFrame([(1, 37)], "labelId int, need long")
    chosen = {r.sourcePath for r in dataset.sample_per_class(df, need).collect()}
    ranked = df.orderBy(F.md5("sourcePath")).limit(37)
    assert chosen == {r.sourcePath for r in ranked.collect()}
    seeded = {r.sourcePath for r in dataset.sample_per_class(df, need, seed=1).collect()}
    assert len(seeded) == 37 and seeded != chosen


@pytest.mark.parametrize("digits, few", [(1, 2), (2, 40), (3, 1_000)])
def test_slices_are_refined_round_by_round(spark, monkeypatch, digits, few):
    monkeypatch.setattr(dataset, "_DIGITS", digits)
    monkeypatch.setattr(dataset, "_FEW", few)
    df = rows_of(spark, {("train", 0): 700, ("train", 1): 90, ("train", 2): 5})
    need = {0: 333, 1: 45, 2: 9, 3: 4}
    table = spark.createDataFrame(list(need.items()), "labelId int, need long")
    got = sorted((r.labelId, r.hash, r.sourcePath) for r in dataset.sample_per_class(df, table).collect())
    every = sorted((r.labelId, r.hash, r.sourcePath) for r in df.withColumn("hash", F.md5("sourcePath")).collect())
    assert got == [row for label, k in need.items() for row in [r for r in every if r[0] == label][:k]]


def test_copies_of_one_key_end_the_digits(spark):
    df = spark.range(3_000).select(F.lit("same").alias("sourcePath"), F.lit(0).alias("labelId"))
    table = spark.createDataFrame([(0, 1_234)], "labelId int, need long")
    assert dataset.sample_per_class(df, table).count() == 1_234


def test_no_window_sees_the_rows_of_a_class(spark):
    """Windows of the sample stand above an aggregation of the boundary slice."""
    df = rows_of(spark, {("train", 1): 500})
    sample = dataset.sample_per_class(df, spark.createDataFrame([(1, 250)], "labelId int, need long"))
    plan = sample._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(n for n, line in enumerate(plan) if "Window" in line)
    assert "Aggregate" in "".join(plan[at + 1 : at + 4])


@pytest.mark.parametrize("need", [0, 1, 499, 500, 600])
def test_sample_sizes_at_the_edges(spark, need):
    df = rows_of(spark, {("train", 1): 500, ("train", 2): 3})
    table = spark.createDataFrame([(1, need)], "labelId int, need long")
    assert dataset.sample_per_class(df, table).count() == min(need, 500)


def test_shortfall_is_reported_and_raised(spark):
    df = rows_of(spark, {("train", 0): 5, ("val", 0): 1, ("train", 1): 200, ("train", 2): 100})
    short = [tuple(r) for r in dataset.rebalance_shortfall(df).collect()]
    assert short == [(0, 99, 5)]
    with pytest.raises(Exception, match="not enough train rows for class 0: required 99, available 5"):
        dataset.rebalance_validation(df).collect()
    taken = dataset.rebalance_validation(df, on_shortfall="take_all")
    assert counts_of(taken)[("val", 0)] == 6


def test_left_anti_and_reassembly(spark):
    all_rows = spark.createDataFrame([(c,) for c in "ABCD"], "sourcePath string")
    moved = spark.createDataFrame([("B",), ("D",), ("D",)], "sourcePath string")
    left = dataset.remove_selected(all_rows, moved)
    assert sorted(r[0] for r in left.collect()) == ["A", "C"]
    assert dataset.reassemble(left, None, moved).count() == 5


def test_weights_equal_numpy(spark):
    labels = np.array([0] * 5 + [1] * 20 + [3] * 7)
    df = spark.createDataFrame(pd.DataFrame({"labelId": labels.astype("int32")}))
    got = {r.labelId: (r.images, r.weight) for r in dataset.class_weights(df).collect()}
    counts = np.bincount(labels)
    assert {k: v[0] for k, v in got.items()} == dict(enumerate(counts))
    assert got[2][1] is None
    assert got[3][1] == pytest.approx(len(labels) / (4 * counts[3]))
    assert dataset.class_weights(df.limit(0)).count() == 0


def test_empty_split_is_an_error(spark):
    df = rows_of(spark, {("train", 0): 1, ("val", 0): 1})
    assert [r[0] for r in dataset.empty_splits(df).collect()] == ["test"]
    with pytest.raises(ValueError, match="test"):
        dataset.split_frames(df)
    assert dataset.split_frames(df, ("train", "val"))["val"].count() == 1


def test_batches_and_load_set(spark):
    df = rows_of(spark, {("train", 0): 50})
    got = dataset.training_batches(df, 16, seed=7).toPandas().sort_values("position")
    assert got.batchNo.value_counts().sort_index().tolist() == [16, 16, 16, 2]
    other = dataset.training_batches(df, 16, seed=8).toPandas().sort_values("position")
    assert other.sourcePath.tolist() != got.sourcePath.tolist()
    originals = spark.createDataFrame([("b",), ("a",), ("c",)], "path string")
    made = [(r.fileName, r.path) for r in dataset.load_set(originals, 7).orderBy("fileName").collect()]
    assert made == [(f"stress_{k:06d}.jpeg", "abc"[k % 3]) for k in range(7)]
    with pytest.raises(ValueError):
        dataset.load_set(originals.limit(0), 3)


def vectors(spark, n=40, size=4, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(f"s{k}", "train", int(k % 3), rng.integers(0, 9, size).astype(float).tolist()) for k in range(n)]
    return spark.createDataFrame(rows, "sourcePath string, split string, labelId int, features array<float>")


@pytest.mark.parametrize("batch_size", [1, 7, 64])
def test_scores_equal_numpy(spark, batch_size):
    df = vectors(spark)
    weights = np.arange(12).reshape(4, 3) % 5 - 2
    got = score(df, linear_model(weights), 2, 2, batch_size).collect()
    for row in got:
        assert row.scores == (np.array(row.features) @ weights).tolist()


def test_argmax_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([([0.05, 0.20, 0.75],), ([0.5, 0.5, 0.0],)], "s array<float>")
    assert [r[0] for r in df.select(best_class(F.col("s"))).collect()] == [2, 0]


def test_models_are_kept_per_path():
    loads = []

    def load(path):
        loads.append(path)
        return lambda tensor: tensor

    assert model_at("x/1", load)() is model_at("x/1", load)()
    assert model_at("x/2", load)() is not model_at("x/1", load)()
    assert loads == ["x/1", "x/2"]


def test_wrong_sizes_have_an_error(spark):
    df = spark.createDataFrame([([1.0] * 4,), ([1.0],), (None,)], "features array<float>")
    assert [r[0] for r in df.select(size_error(2, 2)).collect()] == [
        None, "Expected 4 features, got 1", "Expected 4 features, got 0"]


def test_batch_scores_keep_the_true_class_and_refuse_other_sizes(spark):
    df = vectors(spark)
    weights = np.arange(12).reshape(4, 3) % 5 - 2
    kept = batch_score(df, linear_model(weights), 2, 2, keep=True)
    assert kept.storageLevel.useMemory and kept.count() == df.count()
    assert kept.columns == ["sourcePath", "split", "labelId", "predictedLabelId", "predictedLabel", "score"]
    kept.unpersist()
    odd = df.withColumn("features", F.when(F.col("sourcePath") == "s3", F.array(F.lit(1.0))).otherwise(F.col("features")))
    with pytest.raises(Exception, match="Expected 4 features, got 1"):
        batch_score(odd.withColumn("features", F.col("features").cast("array<float>")), linear_model(weights), 2, 2).collect()


def test_classifier_learns_and_is_served(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(240):
        label = 0 if k < 160 else 1 + k % 2
        rows.append((f"s{k}", label, (rng.normal(0, 0.3, 4) + 2 * np.eye(4)[label]).tolist()))
    df = spark.createDataFrame(rows, "sourcePath string, labelId int, features array<float>")
    model = training.train_classifier(df)
    served = score(df, training.as_predictor(model), 2, 2)
    report = training.evaluate(served).first()
    assert report.images == 240 and report.accuracy > 0.95 and report.loss < 0.5
    own = model.transform(training.with_vector(df)).select("sourcePath", "prediction").collect()
    mine = served.select("sourcePath", best_class(F.col("scores")).cast("double").alias("prediction")).collect()
    assert sorted(own) == sorted(mine)
    table = training.confusion_matrix(served.withColumn("predictedLabelId", best_class(F.col("scores"))))
    assert sum(r.predicted_0 + r.predicted_1 + r.predicted_2 for r in table.collect()) == 240


def test_warmup_is_skipped_by_time_then_batch(spark):
    rows = [(k // 2, k, 10 * k, float(k)) for k in range(6)]
    df = spark.createDataFrame(rows, "timestamp int, batchId long, numInputRows long, processedRowsPerSecond double")
    assert [r.batchId for r in after_warmup(df).orderBy("batchId").collect()] == [2, 3, 4, 5]
    got = bench_summary(df, 3).first()
    assert tuple(got) == (3, 120, 4.0, 240.0)
    assert tuple(bench_summary(df, 9).first()) == (0, 0, None, None)
    assert after_warmup(df, 0).count() == 6


def test_training_batches_survive_repeated_keys(spark):
    rows = spark.createDataFrame([(k % 5, k) for k in range(12)], "sourcePath long, n int")
    got = dataset.training_batches(rows, 4).collect()
    assert sorted(r.n for r in got) == list(range(12)) and sorted(r.position for r in got) == list(range(12))


def test_a_repeated_key_cannot_be_moved(spark):
    rows = [("a", "train", 0)] * 3 + [("b", "val", 0)]
    df = spark.createDataFrame(rows, "sourcePath string, split string, labelId int")
    with pytest.raises(Exception, match="repeated key"):
        dataset.rebalance_validation(df, 3, classes=[0]).collect()


def test_the_slope_of_a_fit_equals_brute_force_and_tells_an_optimum(spark):
    rng = np.random.default_rng(5)
    y = rng.choice(3, 300, p=[0.6, 0.3, 0.1])
    x = (rng.normal(size=(300, 4)) * [1, 3, 0.2, 0] + np.eye(4)[y]).astype(np.float32)
    x[:, 3] = 2
    rows = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(y, x)], "labelId int, features array<float>")
    slopes = {}
    for most in (2, 200):
        model = training.train_classifier(rows, max_iter=most, tolerance=1e-10)
        got = training.optimality(rows, model).first()
        assert (got.images, got.classes) == (300, 3)
        w = (300 / (3 * np.bincount(y)))[y]
        v = x.astype(float)
        z = v @ model.coefficientMatrix.toArray().T + np.asarray(model.interceptVector)
        p = np.exp(z - z.max(1, keepdims=True))
        off = (p / p.sum(1, keepdims=True) - np.eye(3)[y]) * w[:, None] / w.sum()
        middle = (v * w[:, None]).sum(0) / w.sum()
        scale = np.sqrt(((v - middle) ** 2 * w[:, None]).sum(0) / (w.sum() - (w**2).sum() / w.sum()))[:3]
        steep = (off.T @ v)[:, :3] / scale + 0.01 * scale * model.coefficientMatrix.toArray()[:, :3]
        assert got.slope == pytest.approx(max(np.abs(steep).max(), np.abs(off.sum(0)).max()), abs=1e-9)
        slopes[most] = got.slope
    assert slopes[200] < 1e-5 < 1e-2 < slopes[2]
