"""Vectorised rows on their way to the feature store, the predictions or the quarantine."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight import schemas
from tidelight.defaults import CLASS_IDS, CLASS_NAMES
from tidelight.functions.images import vectorize
from tidelight.functions.labels import with_target_class
from tidelight.functions.scoring import Predictor, score, size_error, with_prediction


def infer_outcomes(images: DataFrame, size: int, mode: str | None, partitions: int | None = None) -> DataFrame:
    """One outcome row per image, readable or not."""
    spread = images.repartition(partitions) if partitions else images
    return vectorize(spread, size=size, mode=mode)


def train_outcomes(
    images: DataFrame,
    size: int,
    mode: str | None,
    class_ids: Mapping[str, int] = CLASS_IDS,
    partitions: int | None = None,
) -> DataFrame:
    """Outcome rows with ``split`` and ``labelId``; a label that cannot be resolved counts as failure."""
    labeled = with_target_class(images, class_ids).drop("targetLabel", "label")
    spread = labeled.repartition(partitions) if partitions else labeled
    done = vectorize(spread, size=size, mode=mode)
    return done.withColumns(
        {
            "ok": F.col("ok") & F.col("labelError").isNull(),
            "error": F.coalesce("labelError", "error"),
        }
    ).drop("labelError")


def route_outcomes(df: DataFrame, height: int | None = None, width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected rows; with a model size, vectors that do not fit it are rejected too."""
    if height and width:
        wrong = size_error(height, width)
        df = df.withColumns(
            {
                "error": F.when(F.col("ok"), F.coalesce(wrong, F.lit(""))).otherwise(F.col("error")),
                "ok": F.col("ok") & wrong.isNull(),
            }
        )
    return df.where("ok"), df.where("NOT ok")


def scored_outcomes(
    good: DataFrame,
    make_predictor: Callable[[], Predictor],
    height: int,
    width: int,
    batch_size: int = 64,
    names: Mapping[int, str] = CLASS_NAMES,
) -> DataFrame:
    """Predictions without ``processedAt``, which is known only once they exist."""
    scored = with_prediction(score(good, make_predictor, height, width, batch_size), names)
    return scored.select(*(c for c in schemas.PREDICTIONS.names if c != "processedAt"))


def as_predictions(scored: DataFrame, at: Column) -> DataFrame:
    return scored.withColumn("processedAt", at).select(*schemas.PREDICTIONS.names)


def as_rejected(bad: DataFrame, at: Column) -> DataFrame:
    return bad.withColumn("processedAt", at).select(*schemas.REJECTED.names)


def as_features(good: DataFrame) -> DataFrame:
    return good.select(*schemas.FEATURES.names)


def batch_score(
    features: DataFrame,
    make_predictor: Callable[[], Predictor],
    height: int,
    width: int,
    batch_size: int = 64,
    names: Mapping[int, str] = CLASS_NAMES,
    keep: bool = False,
) -> DataFrame:
    """Score a feature table and keep its true class: ``(sourcePath, split, labelId, prediction...)``.

    A vector of another size is an error; ``dataset.feature_violations`` lists
    such rows. ``keep`` persists the result for callers that count, measure and
    write it.
    """
    wrong = size_error(height, width)
    checked = F.when(wrong.isNull(), F.col("features")).otherwise(F.raise_error(wrong).cast("array<float>"))
    scored = with_prediction(
        score(features.withColumn("features", checked), make_predictor, height, width, batch_size), names
    )
    result = scored.select("sourcePath", "split", "labelId", "predictedLabelId", "predictedLabel", "score")
    return result.persist(StorageLevel.MEMORY_AND_DISK) if keep else result
