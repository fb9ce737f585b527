"""Streaming queries drained over the given tables, then read back from their sinks."""

from __future__ import annotations

import os
import time
import uuid
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from tidelight.defaults import UNDECODABLE, StreamConfig
from tidelight.functions.scoring import linear_model, model_at
from tidelight.functions.storage import locate, qualify
from tidelight.operators.batches import bench_summary
from tidelight.operators.dataset import load_set
from tidelight.operators.outcomes import train_outcomes
from tidelight.operators.replay import deposit_plan, emissions, replay_plan
from tidelight.plans import inputs as i
from tidelight.plans.catalog import Catalog
from tidelight.plans.datasets import linear_scores_sql, pixel_weights
from tidelight.plans.images import PIXELS, by_pixel
from tidelight.session import file_stream_settings, settle, work_folder
from tidelight.sinks import compaction
from tidelight.sinks.deposit import deposit, replay
from tidelight.sinks.tables import append_batch, query_id
from tidelight.sources.files import file_tree, landing_files, stream_reader
from tidelight.sources.tables import features as read_features
from tidelight.sources.tables import metrics as read_metrics
from tidelight.sources.tables import predictions as read_predictions
from tidelight.sources.tables import read_sink
from tidelight.sources.tables import rejected as read_rejected
from tidelight.streaming.ingest import run_for, start_infer, start_scoring, start_storing, start_train, warm_up
from tidelight.streaming.telemetry import watch
from tidelight.streaming.windows import bucket_counts, closed_bucket_runs, closed_runs

PLANS = Catalog()


def _config(spark, incoming: str = "", files_per_batch: int = 0) -> StreamConfig:
    folder = work_folder(spark, "stream")
    return StreamConfig(
        incoming=incoming,
        output=f"{folder}/output",
        rejected=f"{folder}/rejected",
        checkpoint=f"{folder}/checkpoint",
        max_files_per_trigger=files_per_batch,
        delete_processed=False,
        image_size=8,
        resize_mode="scale",
        until_drained=True,
    )


def _drain_vectors(spark, sf_dir):
    cfg = _config(spark)
    vectors = i.as_outcomes(i.as_feature_rows(i.table_stream(spark, sf_dir, "embeddings")))
    query = start_scoring(vectors, cfg, linear_model(pixel_weights()))
    query.awaitTermination()
    return query, cfg


@PLANS.add(f"""WITH {i.OUTCOMES}, raw AS (SELECT *, {linear_scores_sql()} AS s FROM outcomes WHERE len(features) = 64)
SELECT "sourcePath", "fileName", list_position(s, list_max(s)) - 1 AS "predictedLabelId", list_max(s) AS score FROM raw""")
def stream_predictions(spark, sf_dir):
    _, cfg = _drain_vectors(spark, sf_dir)
    done = read_predictions(spark, cfg.output)
    return done.select("sourcePath", "fileName", "predictedLabelId", F.col("score").cast("double").alias("score"))


@PLANS.add(f"""WITH {i.OUTCOMES} SELECT "sourcePath", "fileName", 'Expected 64 features, got 63' AS error
FROM outcomes WHERE len(features) <> 64""")
def stream_quarantine(spark, sf_dir):
    _, cfg = _drain_vectors(spark, sf_dir)
    return read_rejected(spark, cfg.rejected).select("sourcePath", "fileName", "error")


@PLANS.add("""SELECT CAST(count(*) AS BIGINT) AS images, true AS "manyBatches", true AS "countedInSteps" FROM embeddings""")
def stream_metrics(spark, sf_dir):
    """Files counted by the telemetry of a drain in more than a hundred micro-batches, from listener to CSV to summary."""
    files = i.table(spark, sf_dir, "embeddings").count()
    cfg = _config(spark, i.image_tree(spark, sf_dir), files_per_batch=max(1, files // 110))
    folder, name = work_folder(spark, "metrics"), f"count-{uuid.uuid4().hex}"
    listener = watch(spark, folder, flush_seconds=5.0, query_name=name)
    try:
        with file_stream_settings(spark, cfg.max_files_per_trigger):
            paths = stream_reader(spark, cfg, "binaryFile").load(cfg.incoming).select("path")
            drain = paths.writeStream.queryName(name).format("noop").option("checkpointLocation", cfg.checkpoint)
            drain.trigger(availableNow=True).start().awaitTermination()
        if not listener.wait(600):  # it may lag behind short batches
            raise TimeoutError("the telemetry of the drain is not whole")
    finally:
        spark.streams.removeListener(listener)
    rows = read_metrics(spark, folder)
    steady = bench_summary(rows, 2).select("steadyBatches", F.col("images").alias("steadyImages"))
    total = rows.agg(F.sum("numInputRows").alias("images"), F.count("*").alias("batches"))
    return total.join(steady).select(  # one row each
        "images", (F.col("batches") > 100).alias("manyBatches"),
        ((F.col("steadyBatches") == F.col("batches") - 2) & (F.col("steadyImages") < F.col("images"))).alias("countedInSteps"),
    )


@PLANS.add("""SELECT event_id FROM events""")
def two_queries_one_sink(spark, sf_dir):
    """Two queries with checkpoints of their own append to one sink, each from batch 0 on."""
    sink = work_folder(spark, "sink")
    events = i.table_stream(spark, sf_dir, "events").select("event_id")
    for half in (0, 1):
        checkpoint = work_folder(spark, "checkpoint")

        def write(batch, batch_id, checkpoint=checkpoint):
            append_batch(batch, sink, batch_id, query_id(batch.sparkSession, checkpoint))

        part = events.where(F.col("event_id") % 2 == half).writeStream.foreachBatch(write)
        part.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(sink).select("event_id")


@PLANS.add("""SELECT event_id, true AS "fewerFolders", true AS recognised FROM events""")
def compacted_sink(spark, sf_dir):
    """A drain in a hundred batches, compacted and swept; then one compacted and one open batch are replayed."""
    tree, sink, checkpoint = (work_folder(spark, name) for name in ("files", "sink", "checkpoint"))
    events = i.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    events.repartition(100).write.parquet(tree)
    drained: dict[int, str] = {}

    def write(batch, batch_id):
        writer = query_id(batch.sparkSession, checkpoint)
        append_batch(batch, sink, batch_id, writer)
        drained[batch_id] = writer

    files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(tree)
    query = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    newest = max(drained)
    again = {at: spark.read.parquet(f"{sink}/writer={drained[at]}/batch_id={at}").select("event_id", "ts") for at in (1, newest)}
    again = {at: settle(rows) for at, rows in again.items()}
    state = compaction.compact(spark, sink, events.schema, "to_date(ts)")
    compaction.sweep(spark, sink, 0)
    for at, rows in again.items():
        append_batch(rows, sink, at, drained[at])
    few = compaction.batch_folders(spark, sink) < len(drained)
    known = state.holds(drained[1], 1) and not state.holds(drained[newest], newest)
    return read_sink(spark, sink, events.schema).select("event_id", F.lit(few).alias("fewerFolders"), F.lit(known).alias("recognised"))


@PLANS.add(f"""WITH {i.OUTCOMES} SELECT "sourcePath", true AS "afterScoring" FROM outcomes WHERE len(features) = 64""")
def stream_processed_after_scoring(spark, sf_dir):
    """A model that takes its time and scores with the clock: no row is older than its score."""
    cfg = _config(spark)
    begin = time.time()

    def load():
        def predict(tensor):
            time.sleep(0.05)
            return np.full((len(tensor), 1), time.time() - begin, np.float32)

        return predict

    vectors = i.as_outcomes(i.as_feature_rows(i.table_stream(spark, sf_dir, "embeddings")))
    start_scoring(vectors, cfg, load).awaitTermination()
    done = read_predictions(spark, cfg.output)
    late = F.unix_micros("processedAt") / 1e6 - begin >= F.col("score").cast("double") - 0.001
    return done.select("sourcePath", late.alias("afterScoring"))


_PLACE = """concat_ws('/', case vec_id % 10 when 8 then 'val' when 9 then 'test' when 7 then 'spare' else 'train' end,
  if(label % 3 = 0, 'NORMAL', 'PNEUMONIA'), concat(sourcePath, if(label % 3 = 1, '_Bacteria', ''), '.png'))"""


@PLANS.add(f"""WITH files AS (SELECT *, concat('vec_', vec_id, CASE WHEN label % 3 = 1 THEN '_Bacteria' ELSE '' END, '.png')
  AS "fileName", CASE vec_id % 10 WHEN 8 THEN 'val' WHEN 9 THEN 'test' ELSE 'train' END AS split FROM embeddings
  WHERE vec_id % 10 <> 7)
SELECT "fileName", CASE WHEN label % 3 < 2 AND label <> 9 THEN split END AS split,
  CASE WHEN label % 3 < 2 AND label <> 9 THEN CAST(label % 3 AS INT) END AS "labelId",
  CASE WHEN label = 9 THEN '{UNDECODABLE}' WHEN label % 3 = 2
    THEN 'Unable to resolve pneumonia subtype from filename : ' || "fileName" ELSE '' END AS error FROM files""")
def stream_train_tree(spark, sf_dir):
    """A split/label/file tree through the train query: every file ends in the feature store or in quarantine."""
    cfg = _config(spark, i.image_tree(spark, sf_dir, place=_PLACE), files_per_batch=200)
    with file_stream_settings(spark, cfg.max_files_per_trigger, cfg.incoming):
        start_train(spark, cfg).awaitTermination()
    name = F.element_at(F.split("sourcePath", "/"), -1).alias("fileName")
    stored = read_features(spark, cfg.output).select(name, "split", "labelId", F.lit("").alias("error"))
    none = F.lit(None)
    bad = read_rejected(spark, cfg.rejected).select(
        "fileName", none.cast("string").alias("split"), none.cast("int").alias("labelId"), "error"
    )
    return stored.unionByName(bad)


@PLANS.add("""SELECT concat('vec_', vec_id, '.png') AS "fileName" FROM embeddings WHERE label <> 9""")
def stream_restarted(spark, sf_dir):
    """A drain, more files, and a restart on the same checkpoint: every file once."""
    cfg = _config(spark, i.image_tree(spark, sf_dir, "vec_id % 2 = 0"), files_per_batch=500)
    for half in ("vec_id % 2 = 0", "vec_id % 2 = 1"):
        if half.endswith("1"):
            i.image_tree(spark, sf_dir, half, folder=cfg.incoming)
        with file_stream_settings(spark, cfg.max_files_per_trigger, cfg.incoming):
            start_infer(spark, cfg, linear_model(pixel_weights())).awaitTermination()
    return read_predictions(spark, cfg.output).select("fileName")


@PLANS.add("""SELECT count(*) FILTER (WHERE label <> 9) AS predicted, true AS cleaned, true AS stopped FROM embeddings""")
def stream_cleaned_and_bounded(spark, sf_dir):
    """A query of fixed cadence that is stopped after a time; its processed files are deleted."""
    drained = _config(spark, i.image_tree(spark, sf_dir))
    files = i.table(spark, sf_dir, "embeddings").select("vec_id").distinct().count()  # one file each
    cfg = replace(drained, max_files_per_trigger=max(1, files // 4), delete_processed=True, until_drained=False)
    with file_stream_settings(spark, cfg.max_files_per_trigger):
        query = start_infer(spark, cfg, linear_model(pixel_weights()))
        while sum(p.numInputRows for p in query.recentProgress) < files and query.isActive:
            time.sleep(0.2)
        ended = run_for(query, 2)
    left = file_tree(spark, cfg.incoming).count() if files else 0
    return read_predictions(spark, cfg.output).agg(
        F.count("*").alias("predicted"), F.lit(left < files).alias("cleaned"), F.lit(not ended).alias("stopped")
    )


@PLANS.add("""SELECT concat('vec_', vec_id, '.png') AS "fileName" FROM embeddings""")
def replayed_landing_zone(spark, sf_dir):
    """The image tree replayed into a landing zone in batches, and what waits there."""
    files = file_tree(spark, i.image_tree(spark, sf_dir))
    zone = work_folder(spark, "zone")
    total = i.table(spark, sf_dir, "embeddings").count()
    replay(replay_plan(emissions(files, "infer"), batch_size=max(1, total // 3)), zone)
    return landing_files(spark, zone).select("fileName")


@PLANS.add("""WITH wanted AS (SELECT UNNEST(range((SELECT 2 * count(*) FROM embeddings))) AS n)
SELECT 'stress_' || lpad(CAST(n AS VARCHAR), 6, '0') || '.png' AS "fileName" FROM wanted""")
def filled_landing_zone(spark, sf_dir):
    """A zone filled from a load set that takes every file twice, under names of its own."""
    files = file_tree(spark, i.image_tree(spark, sf_dir))
    zone = work_folder(spark, "zone")
    load = load_set(files, 2 * i.table(spark, sf_dir, "embeddings").count(), extension="png")
    deposit(load.select(F.col("path").alias("sourcePath"), F.col("fileName").alias("relativeTarget")), zone)
    return landing_files(spark, zone).select("fileName")


@PLANS.add(f"""WITH {PIXELS} SELECT "sourcePath", CAST(label % 3 AS INT) AS "labelId", pixel,
  CAST(value AS DOUBLE) AS value FROM luma WHERE label % 3 < 2""")
def stream_features(spark, sf_dir):
    """Labelled rasters as a stream into the feature store; labels that do not resolve are quarantined."""
    cfg = _config(spark)
    kind = F.col("label") % 3
    files = i.as_rasters(i.table_stream(spark, sf_dir, "embeddings")).select(
        "sourcePath",
        F.lit("train").alias("split"),
        F.when(kind == 0, "NORMAL").otherwise("PNEUMONIA").alias("label"),
        F.when(kind == 1, "a_bacteria.png").otherwise("plain.png").alias("fileName"),
        F.timestamp_seconds("vec_id").alias("depositedAt"),
        "image",
    )
    start_storing(train_outcomes(files, cfg.image_size, cfg.resize_mode), cfg).awaitTermination()
    return by_pixel(read_features(spark, cfg.output), "sourcePath", "labelId")


@PLANS.add(f"""SELECT concat('vec_', vec_id, '.png') AS "fileName",
  CASE WHEN label = 9 THEN '{UNDECODABLE}' ELSE '' END AS error FROM embeddings""")
def stream_image_files(spark, sf_dir):
    """Image files through the infer stream: each ends in predictions or in quarantine."""
    cfg = _config(spark, i.image_tree(spark, sf_dir), files_per_batch=5_000)
    with file_stream_settings(spark, cfg.max_files_per_trigger):
        start_infer(spark, cfg, linear_model(pixel_weights())).awaitTermination()
    done = read_predictions(spark, cfg.output).select("fileName", F.lit("").alias("error"))
    return done.unionByName(read_rejected(spark, cfg.rejected).select("fileName", "error"))


def _event_stream(spark, sf_dir):
    deposited = F.col("ts").cast("timestamp").alias("depositedAt")
    return i.table_stream(spark, sf_dir, "events").select("event_type", deposited)


@PLANS.add("""WITH hours AS (SELECT date_trunc('hour', ts) AS h FROM events)
SELECT CAST(h AS TIMESTAMP) AS "depositedAt", count(*) AS images FROM hours GROUP BY 1""")
def stream_hourly_counts(spark, sf_dir):
    """Tumbling counts kept by the stream, written whenever they change; the newest version counts."""
    folder = work_folder(spark, "stream")
    counts = bucket_counts(_event_stream(spark, sf_dir), "depositedAt", "1 hour", "31 days")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/out/version={batch_id}")

    query = counts.writeStream.outputMode("update").foreachBatch(write)
    query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    written = spark.read.parquet(f"{folder}/out")
    newest = written.groupBy("depositedAt").agg(F.max_by("images", "version").alias("images"))
    return newest.withColumn("depositedAt", F.col("depositedAt").cast("timestamp_ntz"))


@PLANS.add("""WITH gaps AS (SELECT *, ts - lag(ts) OVER w > INTERVAL 600 SECOND AS pause FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
numbered AS (SELECT *, sum(CASE WHEN pause THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts
  ROWS UNBOUNDED PRECEDING) AS run FROM gaps)
SELECT event_type, min(ts) AS "runStart", max(ts) AS "runEnd", count(*) AS rows FROM numbered GROUP BY event_type, run
HAVING max(ts) + INTERVAL 600 SECOND <= (SELECT max(ts) FROM events)""")
def stream_closed_runs(spark, sf_dir):
    folder = work_folder(spark, "stream")
    runs = closed_runs(_event_stream(spark, sf_dir), "event_type", "depositedAt", "600 seconds", "0 seconds")
    query = runs.writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append")
    query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    done = spark.read.schema(runs.schema).parquet(f"{folder}/out")
    return done.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("runStart", "runEnd")})


@PLANS.add("""WITH buckets AS (SELECT epoch_us(ts) // 12000000 AS bucket, min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi, count(*) AS n
  FROM events WHERE ts IS NOT NULL GROUP BY 1),
gaps AS (SELECT *, lo - lag(hi) OVER w > 120000000 AS pause, bucket - lag(bucket) OVER w > 10 AS apart FROM buckets
  WINDOW w AS (ORDER BY bucket)),
numbered AS (SELECT *, sum(CASE WHEN pause THEN 1 ELSE 0 END) OVER w AS run,
  sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER w AS session FROM gaps WINDOW w AS (ORDER BY bucket ROWS UNBOUNDED PRECEDING)),
sessions AS (SELECT session, (max(bucket) + 1) * 12000000 - 1 + 126000000 AS ends FROM numbered GROUP BY 1)
SELECT 'all' AS zone, make_timestamp(min(lo)) AS "runStart", make_timestamp(max(hi)) AS "runEnd", CAST(sum(n) AS BIGINT) AS rows
FROM numbered JOIN sessions USING (session) WHERE ends <= (SELECT max(epoch_us(ts)) // 1000 * 1000 FROM events) GROUP BY run""")
def stream_single_key_runs(spark, sf_dir):
    """Runs of one key that holds all rows, in two chained stateful steps."""
    folder = work_folder(spark, "stream")
    events = _event_stream(spark, sf_dir).select(F.lit("all").alias("zone"), "depositedAt")
    runs = closed_bucket_runs(events, "zone", "depositedAt", 120, "0 seconds")
    query = runs.writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append")
    query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    done = spark.read.schema(runs.schema).parquet(f"{folder}/out")
    return done.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("runStart", "runEnd")})


@PLANS.add("""SELECT printf('%s_vec_%d.png', upload, vec_id) AS "fileName", CAST(1 AS BIGINT) AS files
FROM embeddings, (SELECT unnest(['first', 'second']) AS upload)""")
def deposited_twice(spark, sf_dir):
    """The same files uploaded twice: each upload lands under names of its own, and depositing a plan again replaces its files."""
    files = file_tree(spark, i.image_tree(spark, sf_dir))
    zone, total = work_folder(spark, "zone"), i.table(spark, sf_dir, "embeddings").count()
    marks = {}
    for upload in ("first", "second"):
        plan = settle(deposit_plan(files, total))
        deposit(plan, zone)
        deposit(plan, zone)
        marks[upload] = plan.select(F.lit(upload).alias("upload"), F.col("relativeTarget").alias("landed"))
    known = marks["first"].unionByName(marks["second"])
    landed = landing_files(spark, zone).select(F.col("fileName").alias("landed")).join(known, "landed", "left")
    original = F.concat_ws("_", "upload", F.substring_index("landed", "_", -2))
    return landed.groupBy(original.alias("fileName")).agg(F.count("*").alias("files"))


@PLANS.add("""SELECT count(*) AS images, CAST(0 AS BIGINT) AS "leftByWarmUp", true AS "onceAProcess" FROM embeddings""")
def model_loads(spark, sf_dir):
    """A warm-up that leaves nothing in the sinks, then a drain; each Python worker process loads the model once at most."""
    cfg, marks, weights = _config(spark), qualify(spark, work_folder(spark, "loads")), pixel_weights()

    def load(path):
        system, root = locate(marks)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{os.getpid()}-{uuid.uuid4().hex}.txt") as mark:
            mark.write(f"{os.getpid()}".encode())
        return linear_model(weights)()

    model = model_at(marks, load)
    warm_up(spark, cfg, model)
    left = read_predictions(spark, cfg.output).count() + read_rejected(spark, cfg.rejected).count()
    vectors = i.as_outcomes(i.as_feature_rows(i.table_stream(spark, sf_dir, "embeddings")))
    start_scoring(vectors, cfg, model).awaitTermination()
    seen = read_predictions(spark, cfg.output).select("fileName").unionByName(read_rejected(spark, cfg.rejected).select("fileName"))
    loads = spark.read.text(marks).groupBy("value").count().agg(F.max("count").alias("most"))
    return seen.agg(F.count("*").alias("images")).join(loads).select(  # one row each
        "images", F.lit(left).cast("long").alias("leftByWarmUp"), (F.col("most") == 1).alias("onceAProcess")
    )
