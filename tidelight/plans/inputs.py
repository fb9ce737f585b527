"""The given tables in the shapes that the operators take.

Every adapter exists twice: as a DataFrame and as a SQL common table expression
of the same rows. Adapters keep all rows of the table they read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelight.session import work_folder
from tidelight.functions.storage import locate, qualify


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a file stream; the glob also fits a table that is a single file."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


# ---- file paths from events -------------------------------------------------

_PATH = """
concat_ws(case when event_id % 4 = 0 then chr(92) else '/' end, 'landing',
  case event_id % 10 when 7 then 'misc' when 8 then 'val' when 9 then 'test' else 'train' end,
  case when event_type in ('view','signup') then 'NORMAL'
       when event_type in ('click','purchase') then 'PNEUMONIA' else 'OTHER' end,
  concat('person', user_id, '_',
    case event_id % 3 when 0 then 'bacteria' when 1 then 'VIRUS' else 'x' end, '_', event_id,
    case event_id % 5 when 0 then '.JPEG' when 1 then '.txt' when 2 then '.png' else '.jpeg' end))
"""

PATHS = f"paths AS (SELECT event_id, ts, {_PATH} AS path FROM events)"

SEGMENTS = f"""{PATHS},
segments AS (SELECT event_id, ts, path, string_split(translate(path, chr(92), '/'), '/') AS s FROM paths),
files AS (SELECT event_id, ts, path, s[-1] AS "fileName", s[-2] AS label, s[-3] AS split,
  lower(split_part(s[-1], '.', -1)) AS extension, len(s) AS segment_count FROM segments),
images AS (SELECT * FROM files WHERE extension IN ('jpg','jpeg','png')),
labeled AS (SELECT * FROM images WHERE segment_count >= 3 AND split IN ('train','test','val')
  AND label IN ('NORMAL','PNEUMONIA'))"""


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", F.expr(_PATH).alias("path"))


# ---- feature vectors from embeddings ----------------------------------------

_SPLIT = "case vec_id % 10 when 8 then 'val' when 9 then 'test' else 'train' end"

# Multiples of 1/256, so that sums of small multiples are exact in any order.
FEATURES = f"""features AS (SELECT concat('vec_', vec_id) AS "sourcePath", {_SPLIT} AS split,
  CAST(label % 3 AS INT) AS "labelId", label, vec_id, 8 AS "featureWidth", 8 AS "featureHeight",
  list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) / 256 AS FLOAT)) AS features
  FROM embeddings)"""


def as_feature_rows(embeddings: DataFrame) -> DataFrame:
    exact = F.transform("embedding", lambda x: (F.floor(x.cast("double") * 256) / 256).cast("float"))
    return embeddings.select(
        F.concat(F.lit("vec_"), "vec_id").alias("sourcePath"),
        F.expr(_SPLIT).alias("split"),
        (F.col("label") % 3).cast("int").alias("labelId"),
        "label",
        "vec_id",
        F.lit(8).alias("featureWidth"),
        F.lit(8).alias("featureHeight"),
        exact.alias("features"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_feature_rows(table(spark, sf_dir, "embeddings"))


# ---- outcomes: the vectors of label 9 lack their last value ------------------

OUTCOMES = f"""{FEATURES},
outcomes AS (SELECT "sourcePath", concat("sourcePath", '.png') AS "fileName",
  CASE WHEN label = 9 THEN features[1:63] ELSE features END AS features FROM features)"""


def as_outcomes(rows: DataFrame) -> DataFrame:
    short = F.slice("features", 1, 63)
    return rows.select(
        "sourcePath",
        F.concat("sourcePath", F.lit(".png")).alias("fileName"),
        F.timestamp_seconds(F.col("vec_id")).alias("depositedAt"),
        "featureWidth",
        "featureHeight",
        F.when(F.col("label") == 9, short).otherwise(F.col("features")).alias("features"),
        F.lit(True).alias("ok"),
        F.lit("").alias("error"),
    )


# ---- 8x8 rasters from embeddings ---------------------------------------------

# Bytes b of the vector; pixel channels are b, 255 - b and 7 b mod 256.
BYTES = """bytes AS (SELECT concat('vec_', vec_id) AS "sourcePath", label, vec_id,
  list_transform(embedding, lambda x: CAST(greatest(0, least(255, floor(CAST(x AS DOUBLE) * 256) + 128)) AS INT)) AS b
  FROM embeddings)"""


def _bytes() -> F.Column:
    return F.transform(
        "embedding",
        lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(x.cast("double") * 256) + 128)).cast("int"),
    )


def _binary(values: F.Column) -> F.Column:
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 2, "0")), ""))


def as_rasters(embeddings: DataFrame) -> DataFrame:
    """``(sourcePath, label, vec_id, image)`` with a decoded BGR image per vector."""
    channels = F.flatten(
        F.transform("b", lambda v: F.array(v, F.lit(255) - v, F.pmod(v * 7, F.lit(256))))
    )
    image = F.struct(
        F.concat(F.lit("vec_"), "vec_id").alias("origin"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(3).alias("nChannels"),
        F.lit(16).alias("mode"),
        _binary(channels).alias("data"),
    )
    return embeddings.withColumn("b", _bytes()).select(
        F.concat(F.lit("vec_"), "vec_id").alias("sourcePath"), "label", "vec_id", image.alias("image")
    )


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_rasters(table(spark, sf_dir, "embeddings"))


def text_rasters(spark: SparkSession, sf_dir: str, width: int = 64, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each whole document as a grey image: its UTF-8 bytes in rows of ``width``, the last row padded."""
    data = F.encode("text", "UTF-8")
    rows = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / width)).cast("int")
    padded = F.rpad(data, rows * width, F.lit(b" "))
    image = F.struct(
        F.col("doc_id").cast("string").alias("origin"),
        rows.alias("height"),
        F.lit(width).alias("width"),
        F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"),
        padded.alias("data"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", *keep, image.alias("image"))


def png(width: int, height: int, rgb: bytes) -> bytes:
    """An RGB image file; the container has no imaging library."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    stride = width * 3
    lines = b"".join(b"\0" + rgb[y * stride : (y + 1) * stride] for y in range(height))
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def image_tree(
    spark: SparkSession, sf_dir: str, where: str = "true", place: str = "concat(sourcePath, '.png')", folder: str | None = None
) -> str:
    """Write each raster as a PNG below the shared folder; label 9 gets broken files. Returns the folder.

    Executors write the files. ``place`` is the path below the folder.
    """
    folder = qualify(spark, folder or work_folder(spark, "images"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = locate(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, label, data in zip(names, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rgb = np.frombuffer(data, np.uint8).reshape(-1, 3)[:, ::-1].tobytes()
                content = b"not an image" if label == 9 else png(8, 8, rgb)
                system.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["sourcePath"])

    source = rasters(spark, sf_dir).where(where).select(F.expr(place).alias("sourcePath"), "label", "image.data")
    source.repartition("sourcePath").mapInArrow(write, "sourcePath string").write.format("noop").mode("overwrite").save()
    return folder


# ---- predictions, rejected files and telemetry from events -------------------

_DONE = "cast(round(value * 1000) as bigint) * 1000"

PREDICTIONS = f"""predictions AS (SELECT event_id, concat('f', event_id, '.jpeg') AS "fileName",
  concat('zone/f', event_id, '.jpeg') AS "sourcePath", CAST(event_id % 3 AS INT) AS "predictedLabelId",
  CASE event_id % 3 WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'PNEUMONIA_BACTERIA' ELSE 'PNEUMONIA_VIRUS' END
    AS "predictedLabel",
  event_type, ts AS "depositedAt", ts + to_microseconds({_DONE}) AS "processedAt" FROM events)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per event, finished ``value`` seconds after the event."""
    name = F.concat(F.lit("f"), "event_id", F.lit(".jpeg"))
    label = F.element_at(
        F.array(F.lit("NORMAL"), F.lit("PNEUMONIA_BACTERIA"), F.lit("PNEUMONIA_VIRUS")),
        (F.col("event_id") % 3 + 1).cast("int"),
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        name.alias("fileName"),
        F.concat(F.lit("zone/"), name).alias("sourcePath"),
        (F.col("event_id") % 3).cast("int").alias("predictedLabelId"),
        label.alias("predictedLabel"),
        "event_type",
        F.col("ts").alias("depositedAt"),
        F.expr(f"timestampadd(MICROSECOND, {_DONE}, ts)").alias("processedAt"),
    )


def sinks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions, and the quarantine that holds the ``error`` events."""
    rows = predictions(spark, sf_dir)
    failed = F.col("event_type") == "error"
    bad = rows.where(failed).withColumn("error", F.concat(F.lit("cannot decode "), "fileName"))
    return rows.where(~failed), bad


METRICS = """metrics AS (SELECT CAST(floor(event_id / 100) AS BIGINT) AS "batchId", min(ts) AS "timestamp",
  count(*) AS "numInputRows",
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS "processedRowsPerSecond",
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS "batchDurationMs"
  FROM events GROUP BY 1)"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry of batches that hold a hundred consecutive events each."""
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    rows = F.count(F.lit(1))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / 100).cast("long").alias("batchId"))
        .agg(
            F.min("ts").alias("timestamp"),
            rows.alias("numInputRows"),
            (cents.cast("double") / 100 / rows).alias("processedRowsPerSecond"),
            cents.alias("batchDurationMs"),
        )
    )
