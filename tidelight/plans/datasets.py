"""Splits, samples, weights, scoring and evaluation over the feature vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidelight.functions.scoring import best_class, best_score, linear_model, score
from tidelight.functions.labels import class_name
from tidelight.operators import dataset, kpi, training
from tidelight.operators.outcomes import batch_score
from tidelight.plans import inputs as i
from tidelight.plans.catalog import Catalog

PLANS = Catalog()

# Validation target of the plans.
_TARGET = 100


def pixel_weights(classes: int = 3) -> np.ndarray:
    """Small whole numbers, so that scores are exact in any order of summation."""
    pixel, cls = np.mgrid[0:64, 1 : classes + 1]
    return ((pixel * cls) % 7 - 3).astype(np.float32)


def linear_scores_sql(column: str = "features") -> str:
    """The model of :func:`pixel_weights` as a SQL list of three doubles."""
    dot = "list_sum(list_transform({c}, lambda x, n: CAST(x AS DOUBLE) * (((n - 1) * {k}) % 7 - 3)))"
    return "[" + ", ".join(dot.format(c=column, k=k) for k in (1, 2, 3)) + "]"


_REBALANCED = f"""{i.FEATURES},
need AS (SELECT "labelId", greatest(0, {_TARGET} - count(*) FILTER (WHERE split = 'val')) AS missing
  FROM features GROUP BY 1),
ranked AS (SELECT "sourcePath", "labelId", md5("sourcePath") AS hash,
  row_number() OVER (PARTITION BY "labelId" ORDER BY md5("sourcePath"), "sourcePath") AS rank
  FROM features WHERE split = 'train'),
moved AS (SELECT ranked.* FROM ranked JOIN need USING ("labelId") WHERE rank <= missing),
rebalanced AS (SELECT f."sourcePath", f."labelId", CASE WHEN m."sourcePath" IS NOT NULL THEN 'val' ELSE f.split END
  AS split FROM features f LEFT JOIN moved m ON f."sourcePath" = m."sourcePath")"""


@PLANS.add(f"""WITH {i.FEATURES} SELECT split, "labelId", count(*) AS images FROM features GROUP BY 1, 2""")
def split_class_counts(spark, sf_dir):
    return dataset.split_class_counts(i.features(spark, sf_dir))


@PLANS.add(f"""WITH {i.FEATURES} SELECT DISTINCT "labelId" FROM features""")
def class_ids(spark, sf_dir):
    return dataset.class_ids(i.features(spark, sf_dir))


@PLANS.add(f"""WITH {i.FEATURES} SELECT max("labelId") + 1 AS classes FROM features""")
def class_count(spark, sf_dir):
    return dataset.class_count(i.features(spark, sf_dir))


# Doubled labels leave every odd id without rows.
_SPARSE = f"""{i.FEATURES}, sparse AS (SELECT label * 2 AS "labelId" FROM features WHERE split = 'train'),
ids AS (SELECT CAST(unnest(range((SELECT max("labelId") + 1 FROM sparse))) AS INT) AS "labelId"),
dense AS (SELECT ids."labelId", count(sparse."labelId") AS images FROM ids LEFT JOIN sparse USING ("labelId") GROUP BY 1)"""


def _sparse_labels(spark, sf_dir):
    rows = i.features(spark, sf_dir).where("split = 'train'")
    return rows.select((F.col("label") * 2).cast("int").alias("labelId"))


@PLANS.add(f"""WITH {_SPARSE} SELECT "labelId", images FROM dense""")
def dense_class_counts(spark, sf_dir):
    return dataset.dense_class_counts(_sparse_labels(spark, sf_dir)).select("labelId", "images")


@PLANS.add(f"""WITH {_SPARSE} SELECT "labelId", images, (SELECT count(*) FROM sparse)
  / nullif((SELECT max("labelId") + 1 FROM sparse) * images, 0) AS weight FROM dense""")
def class_weights(spark, sf_dir):
    return dataset.class_weights(_sparse_labels(spark, sf_dir))


@PLANS.add(f"""WITH {i.FEATURES}, train AS (SELECT * FROM features WHERE split = 'train')
SELECT "sourcePath", "labelId", (SELECT count(*) FROM train) / ((SELECT max("labelId") + 1 FROM train)
  * count(*) OVER (PARTITION BY "labelId")) AS weight FROM train""")
def weighted_rows(spark, sf_dir):
    train = i.features(spark, sf_dir).where("split = 'train'").select("sourcePath", "labelId")
    return dataset.with_class_weight(train)


@PLANS.add(f"""WITH {i.FEATURES}, wanted AS (SELECT unnest(['train', 'val', 'test', 'holdout']) AS split)
SELECT split, count("sourcePath") AS images FROM wanted LEFT JOIN features USING (split) GROUP BY 1""")
def split_sizes(spark, sf_dir):
    return dataset.split_sizes(i.features(spark, sf_dir), ("train", "val", "test", "holdout"))


@PLANS.add(f"""WITH {i.FEATURES}, wanted AS (SELECT unnest(['train', 'val', 'test', 'holdout']) AS split)
SELECT split FROM wanted WHERE split NOT IN (SELECT split FROM features)""")
def empty_splits(spark, sf_dir):
    return dataset.empty_splits(i.features(spark, sf_dir), ("train", "val", "test", "holdout"))


@PLANS.add(f"""WITH {i.FEATURES} SELECT "labelId", count(*) FILTER (WHERE split = 'val') AS "inVal",
  count(*) FILTER (WHERE split = 'train') AS "inTrain",
  greatest(0, 100 - count(*) FILTER (WHERE split = 'val')) AS missing FROM features GROUP BY 1""")
def val_missing(spark, sf_dir):
    return dataset.val_missing(i.features(spark, sf_dir))


@PLANS.add(f"""WITH {i.FEATURES}, need AS (SELECT "labelId",
  greatest(0, 1000000000 - count(*) FILTER (WHERE split = 'val')) AS required,
  count(*) FILTER (WHERE split = 'train') AS available FROM features GROUP BY 1)
SELECT * FROM need WHERE required > available""")
def rebalance_shortfall(spark, sf_dir):
    return dataset.rebalance_shortfall(i.features(spark, sf_dir), 1_000_000_000, classes=None)


@PLANS.add(f"""WITH {_REBALANCED} SELECT "sourcePath", "labelId", split FROM rebalanced""")
def val_rebalance(spark, sf_dir):
    rows = i.features(spark, sf_dir)
    return dataset.rebalance_validation(rows, _TARGET).select("sourcePath", "labelId", "split")


def _moved(spark, sf_dir):
    rows = i.features(spark, sf_dir)
    need = dataset.val_missing(rows, _TARGET).select("labelId", F.col("missing").alias("need"))
    return dataset.sample_per_class(rows.where("split = 'train'"), need)


@PLANS.add(f"""WITH {_REBALANCED} SELECT "labelId", "sourcePath", hash FROM moved""")
def moved_rows(spark, sf_dir):
    return _moved(spark, sf_dir)


@PLANS.add(f"""WITH {i.FEATURES}, ranked AS (SELECT "labelId", "sourcePath", md5('42|' || "sourcePath") AS hash,
  row_number() OVER (PARTITION BY "labelId" ORDER BY md5('42|' || "sourcePath"), "sourcePath") AS rank,
  count(*) OVER (PARTITION BY "labelId") AS n FROM features WHERE split = 'train')
SELECT "labelId", "sourcePath", hash FROM ranked WHERE rank <= n // 2""")
def seeded_sample(spark, sf_dir):
    """Sampling operator: half of the train rows of each class, by a seeded hash."""
    train = i.features(spark, sf_dir).where("split = 'train'")
    need = train.groupBy("labelId").agg(F.expr("count(*) div 2").alias("need"))
    return dataset.sample_per_class(train, need, seed=42)


@PLANS.add(f"""WITH {_REBALANCED} SELECT "sourcePath", "labelId" FROM features f
WHERE split = 'train' AND NOT EXISTS (SELECT 1 FROM moved m WHERE m."sourcePath" = f."sourcePath")""")
def anti_join_train(spark, sf_dir):
    train = i.features(spark, sf_dir).where("split = 'train'").select("sourcePath", "labelId")
    return dataset.remove_selected(train, _moved(spark, sf_dir))


@PLANS.add(f"""WITH {_REBALANCED} SELECT split, "labelId", count(*) AS images FROM rebalanced GROUP BY 1, 2""")
def reassembled_counts(spark, sf_dir):
    """Train without the moved rows, the moved rows as ``val``, and the untouched splits, put together again."""
    rows = i.features(spark, sf_dir).select("sourcePath", "labelId", "split")
    parts = dataset.split_frames(rows)
    moved = _moved(spark, sf_dir).select("sourcePath", "labelId").withColumn("split", F.lit("val"))
    whole = dataset.reassemble(
        dataset.remove_selected(parts["train"], moved), parts["val"], moved, None, parts["test"]
    )
    return dataset.split_class_counts(whole)


@PLANS.add(f"""WITH {i.OUTCOMES} SELECT "sourcePath", CAST(len(features) AS INT) AS actual, 64 AS expected FROM outcomes
WHERE len(features) <> 64""")
def feature_violations(spark, sf_dir):
    return dataset.feature_violations(i.as_outcomes(i.features(spark, sf_dir)))


@PLANS.add(f"""WITH {i.FEATURES} SELECT "sourcePath", 64 AS size, list_sum(list_transform(features,
  lambda x: CAST(x AS DOUBLE))) AS total FROM features""")
def feature_vectors(spark, sf_dir):
    """Arrays as ML vectors, back as arrays for the comparison."""
    from pyspark.ml.functions import vector_to_array

    rows = training.with_vector(i.features(spark, sf_dir)).withColumn("values", vector_to_array("vector"))
    total = F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("sourcePath", F.size("values").alias("size"), total.alias("total"))


@PLANS.add(f"""WITH {i.FEATURES}, numbered AS (SELECT "sourcePath", "labelId",
  row_number() OVER (ORDER BY md5('42|' || "sourcePath"), "sourcePath") - 1 AS position FROM features
  WHERE split = 'train') SELECT *, position // 16 AS "batchNo" FROM numbered""")
def training_batches(spark, sf_dir):
    train = i.features(spark, sf_dir).where("split = 'train'").select("sourcePath", "labelId")
    return dataset.training_batches(train)


@PLANS.add("""WITH scores AS (SELECT vec_id, embedding AS s FROM embeddings),
best AS (SELECT vec_id, list_max(s) AS score, list_position(s, list_max(s)) - 1 AS id FROM scores)
SELECT vec_id, id AS "predictedLabelId", CAST(score AS DOUBLE) AS score,
  CASE id WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'PNEUMONIA_BACTERIA' WHEN 2 THEN 'PNEUMONIA_VIRUS' ELSE 'UNKNOWN' END
    AS "predictedLabel" FROM best""")
def argmax_score(spark, sf_dir):
    scores = F.col("embedding")
    return i.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        best_class(scores).alias("predictedLabelId"),
        best_score(scores).cast("double").alias("score"),
        class_name(best_class(scores)).alias("predictedLabel"),
    )


SCORED = f"""{i.FEATURES}, raw AS (SELECT *, {linear_scores_sql()} AS s FROM features),
scored AS (SELECT *, list_position(s, list_max(s)) - 1 AS "predictedLabelId", list_max(s) AS score FROM raw)"""
_NAME = """CASE "predictedLabelId" WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'PNEUMONIA_BACTERIA' ELSE 'PNEUMONIA_VIRUS' END"""


@PLANS.add(f"""WITH {SCORED} SELECT "sourcePath", split, "labelId", "predictedLabelId", {_NAME} AS "predictedLabel",
  score FROM scored""")
def batch_scoring(spark, sf_dir):
    scored = batch_score(i.features(spark, sf_dir), linear_model(pixel_weights()), 8, 8)
    return scored.withColumn("score", F.col("score").cast("double"))


@PLANS.add(f"""WITH {SCORED} SELECT "sourcePath", "predictedLabelId" FROM scored""")
def single_row_scoring(spark, sf_dir):
    """One row per model call."""
    scored = batch_score(i.features(spark, sf_dir), linear_model(pixel_weights()), 8, 8, batch_size=1)
    return scored.select("sourcePath", "predictedLabelId")


@PLANS.add(f"""WITH {SCORED} SELECT count(*) AS total,
  count(*) FILTER (WHERE "labelId" = "predictedLabelId") AS correct,
  count(*) FILTER (WHERE "labelId" = "predictedLabelId") / count(*) AS accuracy FROM scored""")
def accuracy(spark, sf_dir):
    return kpi.accuracy(batch_score(i.features(spark, sf_dir), linear_model(pixel_weights()), 8, 8))


@PLANS.add(f"""WITH {SCORED} SELECT "labelId", count(*) FILTER (WHERE "predictedLabelId" = 0) AS predicted_0,
  count(*) FILTER (WHERE "predictedLabelId" = 1) AS predicted_1,
  count(*) FILTER (WHERE "predictedLabelId" = 2) AS predicted_2,
  count(*) FILTER (WHERE "predictedLabelId" NOT IN (0, 1, 2)) AS predicted_other FROM scored GROUP BY 1""")
def confusion_matrix(spark, sf_dir):
    return training.confusion_matrix(batch_score(i.features(spark, sf_dir), linear_model(pixel_weights()), 8, 8))


@PLANS.add(f"""WITH {SCORED}, soft AS (SELECT *, list_transform(s, lambda x: exp(x - list_max(s))) AS e FROM scored),
p AS (SELECT *, list_transform(e, lambda x: x / list_sum(e)) AS probs FROM soft WHERE split = 'test')
SELECT count(*) AS images, round(avg(-ln(least(greatest(probs["labelId" + 1], 1e-7), 1 - 1e-7))), 4) AS loss,
  avg(CASE WHEN "predictedLabelId" = "labelId" THEN 1.0 ELSE 0.0 END) AS accuracy FROM p""")
def evaluation(spark, sf_dir):
    """Loss and accuracy on the test split."""
    test = i.features(spark, sf_dir).where("split = 'test'")
    scored = score(test, linear_model(pixel_weights(), softmax=True), 8, 8)
    return training.evaluate(scored).withColumn("loss", F.round("loss", 4))


@PLANS.add("""SELECT vec_id, CAST(label % 3 AS INT) AS "predictedLabelId" FROM embeddings""")
def trained_classes(spark, sf_dir):
    """Classes that the vectors tell apart: the fitted model must name every one."""
    rows = i.features(spark, sf_dir).select(
        "vec_id", "labelId", F.lit(1).alias("featureHeight"), F.lit(3).alias("featureWidth"),
        F.transform(F.array(*map(F.lit, range(3))), lambda c: (c == F.col("labelId")).cast("float") + 0.01 * F.col("features")[0])
        .cast("array<float>").alias("features"),
    )
    model = training.train_classifier(rows, max_iter=20)
    scored = score(rows, training.as_predictor(model), 1, 3)
    return scored.select("vec_id", best_class(F.col("scores")).alias("predictedLabelId"))


@PLANS.add()
def trained_classifier(spark, sf_dir):
    """Fit on the rebalanced train split with class weights, score the test split with the fitted model."""
    rows = dataset.rebalance_validation(i.features(spark, sf_dir), _TARGET)
    parts = dataset.split_frames(rows)
    model = training.train_classifier(parts["train"], max_iter=20)
    return training.evaluate(score(parts["test"], training.as_predictor(model), 8, 8))


@PLANS.add(f"""WITH {i.FEATURES} SELECT count(*) AS images, CAST(count(DISTINCT "labelId") AS INT) AS classes, true AS optimal
FROM features WHERE split = 'train'""")
def trained_optimum(spark, sf_dir):
    """The weighted fit on whole vectors is the optimum: no slope of its convex loss is above a thousandth."""
    train = i.features(spark, sf_dir).where("split = 'train'")
    model = training.train_classifier(train, max_iter=200, tolerance=1e-9)
    at = training.optimality(train, model)
    return at.select("images", "classes", (F.col("slope") < 1e-3).alias("optimal"))
