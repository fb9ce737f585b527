"""Batched model calls and what follows from their scores."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.defaults import CLASS_NAMES
from tidelight.functions.labels import class_name

# A predictor maps a float32 tensor (n, height, width, 1) to scores (n, classes).
Predictor = Callable[[np.ndarray], np.ndarray]

_LOADED: dict[str, Predictor] = {}


def _loaded(path: str, load: Callable[[str], Predictor]) -> Predictor:
    if path not in _LOADED:
        _LOADED[path] = load(path)
    return _LOADED[path]


def model_at(path: str, load: Callable[[str], Predictor]) -> Callable[[], Predictor]:
    """Loader for :func:`score` that keeps one model per path in each Python worker.

    Workers get a function of this module by name. An inner function would bring a copy of the models with it, empty every time.
    """
    return partial(_loaded, path, load)


def linear_model(weights: np.ndarray, bias: np.ndarray | None = None, softmax: bool = False) -> Callable[[], Predictor]:
    """Loader of ``scores = pixels @ weights + bias``, with ``weights`` of shape (pixels, classes)."""
    weights = np.asarray(weights, np.float32)
    bias = np.zeros(weights.shape[1], np.float32) if bias is None else np.asarray(bias, np.float32)

    def predict(tensor: np.ndarray) -> np.ndarray:
        scores = tensor.reshape(len(tensor), -1) @ weights + bias
        if not softmax:
            return scores
        powers = np.exp(scores - scores.max(axis=1, keepdims=True))
        return powers / powers.sum(axis=1, keepdims=True)

    return lambda: predict


def size_error(height: int, width: int) -> Column:
    """Why a vector cannot be a model input; NULL when it can."""
    size = F.coalesce(F.size("features"), F.lit(0))
    # Fixed value: the message text.
    text = F.concat(F.lit(f"Expected {height * width} features, got "), size.cast("string"))
    return F.when(size != height * width, text)


def score(
    df: DataFrame, make_predictor: Callable[[], Predictor], height: int, width: int, batch_size: int = 64
) -> DataFrame:
    """Add ``scores``; every vector must have height x width values (see :func:`size_error`)."""
    predict = predict_batch_udf(
        make_predictor,
        return_type=T.ArrayType(T.FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=[[height, width, 1]],
    )
    return df.withColumn("scores", predict("features"))


def best_class(scores: Column) -> Column:
    """0-based index of the largest score; the first one wins ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def best_score(scores: Column) -> Column:
    return F.array_max(scores)


def with_prediction(df: DataFrame, names: Mapping[int, str] = CLASS_NAMES) -> DataFrame:
    """Replace ``scores`` by ``predictedLabelId``, ``predictedLabel`` and ``score``."""
    picked = df.withColumns(
        {"predictedLabelId": best_class(F.col("scores")), "score": best_score(F.col("scores")).cast("float")}
    )
    return picked.withColumn("predictedLabel", class_name(F.col("predictedLabelId"), names)).drop("scores")
