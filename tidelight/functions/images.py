"""Resize and luminance of decoded images, as one Arrow stage.

The numpy helpers work on one raster; :func:`vectorize` applies them to the rows
of a DataFrame in record batches. Spark decodes the files (``image`` source) and
decides how rows are spread.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelight.defaults import (
    IMAGE_SIZE,
    LUMINANCE_BLUE,
    LUMINANCE_GREEN,
    LUMINANCE_RED,
    RESIZE_MODE,
    UNDECODABLE,
    AugmentConfig,
)

_CUBIC_A = -0.5


def _cubic(x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    near = (_CUBIC_A + 2) * x**3 - (_CUBIC_A + 3) * x**2 + 1
    far = _CUBIC_A * (x**3 - 5 * x**2 + 8 * x - 4)
    return np.where(x <= 1, near, np.where(x < 2, far, 0.0))


@lru_cache(maxsize=256)
def resample_bands(source: int, target: int) -> tuple[tuple[int, np.ndarray], ...]:
    """Per target position the first source position and the weights of bicubic resampling.

    When shrinking, the filter widens to an average; it still spans only a few
    source positions, so a dense weight matrix would mostly multiply by zero.
    """
    scale = source / target
    reach = max(scale, 1.0)
    bands = []
    for center in (np.arange(target) + 0.5) * scale:
        low = max(0, int(np.floor(center - 2 * reach)))
        high = min(source, int(np.ceil(center + 2 * reach)))
        weights = _cubic((np.arange(low, high) + 0.5 - center) / reach)
        bands.append((low, weights / weights.sum()))
    return tuple(bands)


def _resample_rows(rows: np.ndarray, target: int) -> np.ndarray:
    """(source, n) to (target, n)."""
    out = np.empty((target, rows.shape[1]))
    for at, (low, weights) in enumerate(resample_bands(rows.shape[0], target)):
        out[at] = weights @ rows[low : low + len(weights)].astype(np.float64)
    return out


def resample(raster: np.ndarray, height: int, width: int) -> np.ndarray:
    """A (h, w, channels) byte raster stretched to (height, width, channels)."""
    if raster.shape[:2] == (height, width):
        return raster
    rows, columns, channels = raster.shape
    tall = _resample_rows(raster.reshape(rows, -1), height).reshape(height, columns, channels)
    across = _resample_rows(tall.transpose(1, 0, 2).reshape(columns, -1), width)
    out = across.reshape(width, height, channels).transpose(1, 0, 2)
    # Rounded twice, so that a tie does not hang on the order of summation.
    return np.clip(np.rint(out.round(6)), 0, 255).astype(np.uint8)


def fit_shape(height: int, width: int, target_height: int, target_width: int, fill: bool) -> tuple[int, int]:
    """Size with the same aspect that just fits into the target, or just covers it."""
    ratios = (target_height / height, target_width / width)
    ratio = max(ratios) if fill else min(ratios)
    return max(1, round(height * ratio)), max(1, round(width * ratio))


def resize(raster: np.ndarray, height: int, width: int, mode: str | None) -> np.ndarray:
    """``scale`` stretches, ``cover`` fills and crops the centre, anything else fits on black."""
    mode = (mode or "").strip().lower()
    if mode == "scale":
        return resample(raster, height, width)
    inner = fit_shape(*raster.shape[:2], height, width, fill=mode == "cover")
    scaled = resample(raster, *inner)
    if mode == "cover":
        top, left = (inner[0] - height) // 2, (inner[1] - width) // 2
        return scaled[top : top + height, left : left + width]
    canvas = np.zeros((height, width, raster.shape[2]), np.uint8)
    top, left = (height - inner[0]) // 2, (width - inner[1]) // 2
    canvas[top : top + inner[0], left : left + inner[1]] = scaled
    return canvas


def luminance(raster: np.ndarray) -> np.ndarray:
    """Row-major luminance in 0..1 of a BGR(A) or grey byte raster."""
    planes = raster.astype(np.float32)
    blue, green, red = (planes[..., 0],) * 3 if raster.shape[2] == 1 else np.moveaxis(planes[..., :3], -1, 0)
    mixed = np.float32(LUMINANCE_RED) * red + np.float32(LUMINANCE_GREEN) * green
    return ((mixed + np.float32(LUMINANCE_BLUE) * blue) / np.float32(255)).ravel()


def raster_of(image: dict | None) -> np.ndarray | None:
    """The byte raster of an image struct; ``None`` when Spark could not decode the file."""
    if image is None or image["height"] <= 0 or image["width"] <= 0 or image["nChannels"] <= 0:
        return None
    shape = (image["height"], image["width"], image["nChannels"])
    pixels = np.frombuffer(image["data"], np.uint8)
    return pixels.reshape(shape) if pixels.size == np.prod(shape) else None


def _float_lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([r.size for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.float32)))


_FLOATS = T.ArrayType(T.FloatType(), True)
_EMPTY = np.empty(0, np.float32)


def _outcome(image: dict | None, size: int, mode: str | None) -> tuple[int, int, np.ndarray, bool, str]:
    raster = raster_of(image)
    if raster is None:
        return 0, 0, _EMPTY, False, UNDECODABLE
    try:
        resized = resize(raster, size, size, mode)
        return size, size, luminance(resized), True, ""
    except Exception as failure:  # one bad file must not end a stream
        return 0, 0, _EMPTY, False, str(failure) or type(failure).__name__


def vectorize(
    df: DataFrame, image: str = "image", size: int = IMAGE_SIZE, mode: str | None = RESIZE_MODE
) -> DataFrame:
    """Replace the image struct by ``featureWidth, featureHeight, features, ok, error``.

    Total: an undecodable image gives ``ok = false``, zero size and no features.
    """
    kept = [c for c in df.columns if c != image]
    schema = T.StructType(
        [df.schema[c] for c in kept]
        + [
            T.StructField("featureWidth", T.IntegerType()),
            T.StructField("featureHeight", T.IntegerType()),
            T.StructField("features", _FLOATS),
            T.StructField("ok", T.BooleanType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = batch.column(batch.schema.get_field_index(image))
            done = [_outcome(images[i].as_py(), size, mode) for i in range(batch.num_rows)]
            widths, heights, vectors, oks, errors = map(list, zip(*done)) if done else ([], [], [], [], [])
            new = [
                pa.array(widths, pa.int32()),
                pa.array(heights, pa.int32()),
                _float_lists(vectors),
                pa.array(oks, pa.bool_()),
                pa.array(errors, pa.string()),
            ]
            old = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(old + new, schema.names)

    return df.select(*kept, image).mapInArrow(stage, schema)


def luminance_expr(image: str = "image") -> Column:
    """:func:`luminance` as a native expression over BGR(A) or grey image structs, without a Python worker.

    Higher-order functions are interpreted, so the Arrow stage wins on large rasters.
    """
    channels = F.col(f"{image}.nChannels")
    pixels = F.col(f"{image}.height") * F.col(f"{image}.width")
    digits = F.regexp_extract_all(F.hex(F.col(f"{image}.data")), F.lit("(..)"), 1)
    samples = F.transform(digits, lambda pair: F.conv(pair, 16, 10).cast("float"))

    def mixed(sample: Column, first: Column) -> Column:
        def weighed(weight: float, channel: int) -> Column:
            return F.lit(weight).cast("float") * F.get(sample, first + F.when(channels >= 3, channel).otherwise(0))

        total = weighed(LUMINANCE_RED, 2) + weighed(LUMINANCE_GREEN, 1) + weighed(LUMINANCE_BLUE, 0)
        return (total / F.lit(255.0).cast("float")).cast("float")

    starts = F.sequence(F.lit(0), (pixels - 1) * channels, channels)
    # The one-element array binds the samples to a variable, so they are made once per image.
    return F.transform(F.array(samples), lambda s: F.transform(starts, lambda at: mixed(s, at)))[0]


# ---- random distortions for training ---------------------------------------


# The step between counters and the factors of the 32-bit mix.
COUNTER_STEP, FIRST_FACTOR, SECOND_FACTOR = 2654435769, 2146121005, 2221713035
_DRAWS = ("zoomY", "zoomX", "shiftY", "shiftX", "turn", "contrast")


def uniform_draw(key: Column | str, seed: int, copy: Column | str, counter: int) -> Column:
    """A number in [0, 1): the first 52 bits of the MD5 of ``key|seed|copy|counter``, so any engine draws the same."""
    return F.conv(F.substring(_counter_digest(key, seed, copy, counter), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _counter_digest(key: Column | str, seed: int, copy: Column | str, counter: int) -> Column:
    name = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    number = (F.col(copy) if isinstance(copy, str) else copy).cast("string")
    return F.md5(F.concat_ws("|", name, F.lit(str(seed)), number, F.lit(str(counter))).cast("binary"))


def drawn_distortion(cfg: AugmentConfig, key: Column | str, seed: int, copy: Column | str) -> Column:
    """The parameters of one distorted copy as a struct; ``noise`` (32 bits) is where its counters of noise begin."""
    ranges = (
        (-cfg.zoom_in_max, cfg.zoom_out_max), (-cfg.zoom_in_max, cfg.zoom_out_max), (-cfg.vertical_shift, cfg.vertical_shift),
        (-cfg.horizontal_shift, cfg.horizontal_shift), (-cfg.rotation, cfg.rotation), (-cfg.contrast, cfg.contrast),
    )
    drawn = [
        (F.lit(low) + uniform_draw(key, seed, copy, at) * F.lit(high - low)).alias(name)
        for at, (name, (low, high)) in enumerate(zip(_DRAWS, ranges))
    ]
    noise = F.conv(F.substring(_counter_digest(key, seed, copy, len(_DRAWS)), 1, 8), 16, 10).cast("long")
    return F.struct(*drawn, noise.alias("noise"))


def counter_normals(begin: int, count: int) -> np.ndarray:
    """``count`` standard normal numbers from the counters ``begin``, ``begin`` + 1, ...: two mixed counters each."""
    low = np.uint64(0xFFFFFFFF)
    x = (np.uint64(begin) + np.arange(2 * count, dtype=np.uint64) * np.uint64(COUNTER_STEP)) & low
    x = (x ^ x >> np.uint64(16)) * np.uint64(FIRST_FACTOR) & low
    x = (x ^ x >> np.uint64(15)) * np.uint64(SECOND_FACTOR) & low
    u = ((x ^ x >> np.uint64(16)).astype(np.float64) + 0.5) / 4294967296.0
    return np.sqrt(-2 * np.log(u[::2])) * np.cos(2 * np.pi * u[1::2])


def _distort(vector: np.ndarray, height: int, width: int, drawn: dict[str, float], noise_stddev: float) -> np.ndarray:
    """Zoom, shift, rotate (bilinear, black outside), then contrast and noise."""
    zoom_y, zoom_x = 1 + drawn["zoomY"], 1 + drawn["zoomX"]
    shift_y, shift_x = drawn["shiftY"] * height, drawn["shiftX"] * width
    turn = drawn["turn"] * 2 * np.pi
    noise = counter_normals(drawn["noise"], height * width) * noise_stddev if noise_stddev else 0.0

    y, x = np.mgrid[0:height, 0:width] - np.array([(height - 1) / 2, (width - 1) / 2])[:, None, None]
    source_y = (np.cos(turn) * y - np.sin(turn) * x) * zoom_y + (height - 1) / 2 - shift_y
    source_x = (np.sin(turn) * y + np.cos(turn) * x) * zoom_x + (width - 1) / 2 - shift_x
    framed = np.pad(vector.reshape(height, width), 1)
    source_y, source_x = np.clip(source_y + 1, 0, height + 1), np.clip(source_x + 1, 0, width + 1)
    top = np.minimum(source_y.astype(int), height)
    left = np.minimum(source_x.astype(int), width)
    down, right = source_y - top, source_x - left
    moved = (
        framed[top, left] * (1 - down) * (1 - right)
        + framed[top + 1, left] * down * (1 - right)
        + framed[top, left + 1] * (1 - down) * right
        + framed[top + 1, left + 1] * down * right
    )
    mean = moved.mean()
    return (np.clip((moved - mean) * (1 + drawn["contrast"]) + mean, 0, 1).ravel() + noise).astype(np.float32)


def augment(
    df: DataFrame, copies: int = 1, seed: int = 0, cfg: AugmentConfig = AugmentConfig(), key: str = "sourcePath"
) -> DataFrame:
    """``copies`` randomly distorted rows per feature row, numbered by ``copyNo``.

    The random numbers are drawn by expressions from the key, the copy number, the seed and a counter alone, so a retried
    task, or another engine, writes the same rows. Arrow batches carry them to the kernel that moves the pixels.
    """
    numbered = df.withColumn("copyNo", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    drawn = numbered.withColumn("_drawn", drawn_distortion(cfg, key, seed, "copyNo"))
    schema = numbered.schema
    names = numbered.columns

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: Callable[[str], pa.Array] = lambda c: batch.column(batch.schema.get_field_index(c))
            vectors, heights, widths = at("features"), at("featureHeight").to_numpy(), at("featureWidth").to_numpy()
            rows = [
                _distort(np.asarray(vectors[i].values, np.float32), int(heights[i]), int(widths[i]), parameters, cfg.noise_stddev)
                for i, parameters in enumerate(at("_drawn").to_pylist())
            ]
            columns = [_float_lists(rows) if c == "features" else at(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return drawn.mapInArrow(stage, schema)
