"""Paths, labels and replay plans over the files named by the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelight.functions.labels import class_name, with_label_id, with_label_name, with_target_class
from tidelight.functions.paths import has_target, keep_images, keep_labeled, relative_target, strip_scheme, with_path_columns
from tidelight.operators.dataset import load_set
from tidelight.operators.replay import deposit_plan, emissions, replay_plan
from tidelight.plans import inputs as i
from tidelight.plans.catalog import Catalog

PLANS = Catalog()

_TARGET = """CASE WHEN label = 'NORMAL' THEN 'NORMAL'
  WHEN label = 'PNEUMONIA' AND contains(lower("fileName"), 'bacteria') THEN 'PNEUMONIA_BACTERIA'
  WHEN label = 'PNEUMONIA' AND contains(lower("fileName"), 'virus') THEN 'PNEUMONIA_VIRUS' END"""
_ID = "CASE target WHEN 'NORMAL' THEN 0 WHEN 'PNEUMONIA_BACTERIA' THEN 1 WHEN 'PNEUMONIA_VIRUS' THEN 2 END"


@PLANS.add(f"""WITH {i.SEGMENTS}
SELECT event_id, "fileName", label, split, extension, CAST(segment_count AS INT) AS "segmentCount" FROM files""")
def path_columns(spark, sf_dir):
    files = with_path_columns(i.paths(spark, sf_dir))
    return files.select("event_id", "fileName", "label", "split", "extension", F.size("segments").alias("segmentCount"))


@PLANS.add(f"""WITH {i.SEGMENTS} SELECT path AS "sourcePath", "fileName", ts AS "depositedAt" FROM images""")
def image_files(spark, sf_dir):
    files = keep_images(with_path_columns(i.paths(spark, sf_dir)))
    return files.select(F.col("path").alias("sourcePath"), "fileName", F.col("ts").alias("depositedAt"))


@PLANS.add(f"""WITH {i.SEGMENTS}, targets AS (SELECT *, {_TARGET} AS target FROM labeled)
SELECT path AS "sourcePath", split, label, "fileName", target AS "targetLabel", {_ID} AS "labelId",
  target AS "className" FROM targets WHERE target IS NOT NULL""")
def labeled_files(spark, sf_dir):
    files = with_target_class(keep_labeled(with_path_columns(i.paths(spark, sf_dir))))
    return files.where(has_target(F.col("path"))).select(
        F.col("path").alias("sourcePath"), "split", "label", "fileName", "targetLabel", "labelId",
        class_name(F.col("labelId")).alias("className"),
    )


@PLANS.add(f"""WITH {i.SEGMENTS}, targets AS (SELECT *, {_TARGET} AS target FROM images)
SELECT path AS "sourcePath", CASE WHEN label = 'PNEUMONIA'
  THEN 'Unable to resolve pneumonia subtype from filename : ' || "fileName"
  ELSE 'Unsupported raw label ''' || label || ''' for file: ' || "fileName" END AS error
FROM targets WHERE target IS NULL""")
def label_rejects(spark, sf_dir):
    files = with_target_class(keep_images(with_path_columns(i.paths(spark, sf_dir))))
    return files.where(~has_target(F.col("path"))).select(
        F.col("path").alias("sourcePath"), F.col("labelError").alias("error")
    )


@PLANS.add(f"""WITH {i.SEGMENTS}, targets AS (SELECT *, {_TARGET} AS target FROM labeled)
SELECT split, target AS "targetLabel", count(*) AS images FROM targets WHERE target IS NOT NULL GROUP BY 1, 2""")
def labeled_counts(spark, sf_dir):
    return labeled_files(spark, sf_dir).groupBy("split", "targetLabel").agg(F.count(F.lit(1)).alias("images"))


@PLANS.add(f"""WITH {i.SEGMENTS}
SELECT event_id, split || '/' || label || '/' || "fileName" AS "trainTarget", "fileName" AS "inferTarget"
FROM labeled""")
def relative_targets(spark, sf_dir):
    files = keep_labeled(with_path_columns(i.paths(spark, sf_dir)))
    return files.select(
        "event_id", relative_target("train").alias("trainTarget"), relative_target("infer").alias("inferTarget")
    )


@PLANS.add(f"""WITH {i.PATHS} SELECT event_id, '/data/' || path AS path FROM paths""")
def stripped_paths(spark, sf_dir):
    uri = F.concat(F.lit("file:/data/"), "path")
    return i.paths(spark, sf_dir).select("event_id", strip_scheme(uri).alias("path"))


@PLANS.add(f"""WITH {i.SEGMENTS}, numbered AS (SELECT path AS "sourcePath",
  split || '/' || label || '/' || "fileName" AS "relativeTarget",
  row_number() OVER (ORDER BY path) - 1 AS position FROM labeled)
SELECT *, position // 64 AS "batchNo" FROM numbered""", name="replay_plan")
def replay_batches(spark, sf_dir):
    return replay_plan(emissions(i.paths(spark, sf_dir), "train"), batch_size=64)


@PLANS.add(f"""WITH {i.SEGMENTS}, numbered AS (SELECT path AS "sourcePath", "fileName" AS "relativeTarget",
  row_number() OVER (ORDER BY path) - 1 AS position FROM images)
SELECT *, position // 100 AS "batchNo" FROM numbered WHERE position < 1000""")
def replay_first_thousand(spark, sf_dir):
    """The replay's own limit on the number of emitted files."""
    return replay_plan(emissions(i.paths(spark, sf_dir), "infer"), batch_size=100, limit=1000)


@PLANS.add(f"""WITH {i.SEGMENTS}
SELECT path AS "sourcePath", 'val/PNEUMONIA/' || substr(md5('token' || path), 1, 8) || '_virus_' || "fileName"
  AS "relativeTarget" FROM images ORDER BY path LIMIT 20""", name="deposit_plan")
def deposits(spark, sf_dir):
    """The first n files in path order: n is what the user asks to deposit."""
    files = keep_images(with_path_columns(i.paths(spark, sf_dir)))
    return deposit_plan(files, 20, subtype="virus", folder="val/PNEUMONIA", token="token")


@PLANS.add(f"""WITH {i.SEGMENTS}, originals AS (SELECT path, row_number() OVER (ORDER BY path) - 1 AS n FROM images)
SELECT printf('stress_%06d.jpeg', id) AS "fileName", path
FROM range(2 * (SELECT count(*) FROM images)) r(id)
JOIN originals ON originals.n = id % (SELECT count(*) FROM images)""", name="load_set")
def doubled_load_set(spark, sf_dir):
    originals = keep_images(with_path_columns(i.paths(spark, sf_dir))).select("path")
    return load_set(originals, 2 * originals.count())


@PLANS.add("""SELECT vec_id, label AS "labelId", CASE label WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'PNEUMONIA_BACTERIA'
  WHEN 2 THEN 'PNEUMONIA_VIRUS' ELSE 'UNKNOWN' END AS "labelName" FROM embeddings""")
def label_names(spark, sf_dir):
    ids = i.table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("labelId"))
    return with_label_name(ids)


@PLANS.add(f"""WITH {i.SEGMENTS}, targets AS (SELECT *, {_TARGET} AS target FROM labeled)
SELECT event_id, target AS "labelName", {_ID} AS "labelId" FROM targets""")
def label_ids(spark, sf_dir):
    files = with_target_class(keep_labeled(with_path_columns(i.paths(spark, sf_dir))))
    return with_label_id(files.select("event_id", F.col("targetLabel").alias("labelName"))).select(
        "event_id", "labelName", "labelId"
    )
