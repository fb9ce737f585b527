"""Weighted classifier on luminance vectors, and its evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.defaults import CLASS_IDS
from tidelight.functions.scoring import Predictor, linear_model
from tidelight.operators.dataset import with_class_weight


def with_vector(df: DataFrame, features: str = "features", out: str = "vector") -> DataFrame:
    """Feature arrays as the ML vector type."""
    return df.withColumn(out, array_to_vector(features))


def _weighed(train: DataFrame, label: str, weighted: bool) -> DataFrame:
    rows = train.select(label, "features")
    return with_class_weight(rows, label) if weighted else rows.withColumn("weight", F.lit(1.0))


def train_classifier(
    train: DataFrame, label: str = "labelId", max_iter: int = 50, reg_param: float = 0.01, weighted: bool = True,
    tolerance: float = 1e-6,
) -> LogisticRegressionModel:
    """Multinomial logistic regression; rows of rare classes weigh more."""
    rows = _weighed(train, label, weighted)
    fit = LogisticRegression(
        featuresCol="vector", labelCol=label, weightCol="weight", family="multinomial", tol=tolerance,
        maxIter=max_iter, regParam=reg_param, probabilityCol="probability", predictionCol="prediction",
    )
    return fit.fit(with_vector(rows).select(label, "vector", "weight"))


def as_predictor(model: LogisticRegressionModel) -> Callable[[], Predictor]:
    """The fitted model as a loader for :func:`tidelight.functions.scoring.score`."""
    return linear_model(model.coefficientMatrix.toArray().T, np.asarray(model.interceptVector), softmax=True)


def optimality(
    train: DataFrame, model: LogisticRegressionModel, label: str = "labelId", reg_param: float = 0.01, weighted: bool = True
) -> DataFrame:
    """One row: ``images``, ``classes`` and ``slope``, the steepest slope of the fitted loss at the model's coefficients.

    The loss is the weighted mean of the cross-entropy plus ``reg_param`` / 2 times the squares of the coefficients of standardised
    features. It is convex, so a slope of zero proves the optimum, whatever way led there. Slopes are per standardised feature; one
    that never changes has none. Each pass sums map-side to one row per feature.
    """
    weights, intercepts = model.coefficientMatrix.toArray(), np.asarray(model.interceptVector)
    classes = range(len(intercepts))
    x = F.transform("features", lambda v: v.cast("double"))

    def logit(k: int) -> Column:
        products = F.zip_with("x", F.lit([float(v) for v in weights[k]]), lambda a, b: a * b)
        return F.aggregate(products, F.lit(float(intercepts[k])), lambda total, v: total + v)

    rows = _weighed(train, label, weighted).select(label, F.col("weight").alias("w"), x.alias("x"))
    rows = rows.withColumn("z", F.array(*map(logit, classes))).withColumn("top", F.array_max("z"))
    rows = rows.withColumn("e", F.transform("z", lambda v: F.exp(v - F.col("top"))))
    rows = rows.withColumn("all", F.aggregate("e", F.lit(0.0), lambda total, v: total + v))
    off = [(F.col("w") * (F.col("e")[k] / F.col("all") - (F.col(label) == k).cast("double"))).alias(f"off{k}") for k in classes]
    # The constant that carries the intercept goes before the features, as feature -1.
    spread = rows.select("w", *off, F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("at", "v"))
    sums = spread.groupBy("at").agg(
        F.count("*").alias("images"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("w")).alias("ww"),
        F.sum(F.col("w") * F.col("v")).alias("wv"), F.sum(F.col("w") * F.col("v") * F.col("v")).alias("wvv"),
        *(F.sum(F.col(f"off{k}") * F.col("v")).alias(f"g{k}") for k in classes),
    )
    variance = (F.col("wvv") - F.col("wv") * F.col("wv") / F.col("w")) / (F.col("w") - F.col("ww") / F.col("w"))
    scale = F.when(F.col("at") == 0, 1.0).otherwise(F.sqrt(F.greatest(variance, F.lit(0.0))))
    sums = sums.withColumn("scale", scale).where("scale > 0")

    def slope(k: int) -> Column:
        held = F.element_at(F.lit([0.0, *(float(v) for v in weights[k])]), F.col("at") + 1)
        return F.abs(F.col(f"g{k}") / F.col("w") / F.col("scale") + reg_param * F.col("scale") * held)

    return sums.agg(
        F.max("images").alias("images"), F.lit(len(intercepts)).alias("classes"), F.max(F.greatest(*map(slope, classes))).alias("slope")
    )


def confusion_matrix(
    df: DataFrame, truth: str = "labelId", predicted: str = "predictedLabelId",
    classes: Iterable[int] = tuple(sorted(CLASS_IDS.values())),
) -> DataFrame:
    """One row per true class, one column ``predicted_<id>`` per class, and ``predicted_other`` for any other or no id."""
    ids = list(classes)
    counts = [F.count_if(F.col(predicted) == c).alias(f"predicted_{c}") for c in ids]
    other = F.count_if(F.coalesce(~F.col(predicted).isin(ids), F.lit(True))).alias("predicted_other")
    return df.groupBy(truth).agg(*counts, other)


def evaluate(df: DataFrame, truth: str = "labelId", scores: str = "scores", floor: float = 1e-7) -> DataFrame:
    """Rows, mean cross-entropy and accuracy of class probabilities."""
    chosen = F.try_element_at(F.col(scores), (F.col(truth) + 1).cast("int")).cast("double")
    bounded = F.least(F.greatest(F.coalesce(chosen, F.lit(0.0)), F.lit(floor)), F.lit(1.0 - floor))
    best = F.array_position(F.col(scores), F.array_max(F.col(scores))) - 1
    return df.agg(
        F.count(F.lit(1)).alias("images"),
        F.avg(-F.ln(bounded)).alias("loss"),
        F.avg((best == F.col(truth)).cast("double")).alias("accuracy"),
    )
