import threading
import time
import uuid
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelight import schemas
from tidelight.defaults import EMPTY_FILE, UNDECODABLE, StreamConfig
from tidelight.functions.scoring import linear_model
from tidelight.functions.storage import locate
from tidelight.operators.batches import bench_summary
from tidelight.operators.replay import deposit_plan, emissions, replay_plan
from tidelight.plans.inputs import png
from tidelight.plans import streams
from tidelight.session import file_stream_settings, work_folder
from tidelight.sinks.deposit import deposit, replay
from tidelight.sinks.tables import append_batch, quarantine_empty, write_inferred
from tidelight.sources import tables
from tidelight.sources.files import empty_files, file_tree, landing_files
from tidelight.streaming.ingest import run_for, start_infer, start_train, warm_up
from tidelight.streaming.telemetry import MetricsListener, watch
from tidelight.streaming.windows import closed_bucket_runs

GREY = {name: png(4, 4, bytes([value] * 48)) for name, value in {"dark": 10, "light": 250}.items()}
# Class 0 for dark images, class 2 for light ones.
MODEL = linear_model(np.stack([np.full(16, -1.0), np.zeros(16), np.full(16, 1.0)], 1), np.array([8.0, 0.0, -8.0]))


def config(tmp_path, **options):
    defaults = dict(
        incoming=str(tmp_path / "zone"), output=str(tmp_path / "out"), rejected=str(tmp_path / "rejected"),
        checkpoint=str(tmp_path / "checkpoint"), image_size=4, until_drained=True, delete_processed=False,
    )
    return StreamConfig(**{**defaults, **options})


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_bytes(content)


def test_infer_routes_every_file_and_resumes(spark, tmp_path):
    zone = tmp_path / "zone"
    put(zone, a__png=GREY["dark"], b__PNG=GREY["light"], bad__jpg=b"junk", c__txt=b"no", empty__png=b"")
    put(zone / "sub", d__png=GREY["light"])
    put(zone / "_staging", e__png=GREY["light"])
    cfg = config(tmp_path, max_files_per_trigger=2)
    query = start_infer(spark, cfg, MODEL)
    assert run_for(query, 120)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3  # the empty file is listed, not read
    done = {r.fileName: r for r in tables.predictions(spark, cfg.output).collect()}
    assert {n: r.predictedLabelId for n, r in done.items()} == {"a.png": 0, "b.PNG": 2, "d.png": 2}
    assert done["a.png"].predictedLabel == "NORMAL"
    assert all(r.depositedAt <= r.processedAt for r in done.values())
    bad = tables.rejected(spark, cfg.rejected).collect()
    assert [(r.fileName, r.error) for r in bad] == [("bad.jpg", UNDECODABLE)]
    put(zone / "_staging", z__png=b"")
    empty = empty_files(spark, cfg.incoming)
    assert [r.fileName for r in empty.collect()] == ["empty.png"]
    for _ in range(2):
        quarantine_empty(empty, tables.rejected(spark, cfg.rejected), cfg.rejected)
    errors = sorted(r.error for r in tables.rejected(spark, cfg.rejected).collect())
    assert errors == [EMPTY_FILE, UNDECODABLE]
    assert {r.fileName for r in landing_files(spark, cfg.incoming).collect()} == {"a.png", "b.PNG", "bad.jpg", "d.png"}

    put(zone, f__png=GREY["dark"])
    run_for(start_infer(spark, cfg, MODEL), 120)
    assert tables.predictions(spark, cfg.output).count() == 4


def test_train_fills_the_feature_store(spark, tmp_path):
    zone = tmp_path / "zone"
    put(zone / "train" / "NORMAL", a__png=GREY["dark"], bad__png=b"junk")
    put(zone / "val" / "PNEUMONIA", x_bacteria__png=GREY["light"], x_none__png=GREY["light"])
    put(zone / "train" / "OTHER", a__png=GREY["dark"])
    put(zone / "misc" / "NORMAL", a__png=GREY["dark"])
    cfg = config(tmp_path)
    run_for(start_train(spark, cfg), 120)
    got = tables.features(spark, cfg.output).collect()
    assert sorted((r.split, r.labelId, r.featureWidth) for r in got) == [("train", 0, 4), ("val", 1, 4)]
    assert {round(r.features[0], 4) for r in got} == {round(10 / 255, 4), round(250 / 255, 4)}
    bad = {r.fileName: r.error for r in tables.rejected(spark, cfg.rejected).collect()}
    assert bad["bad.png"] == UNDECODABLE
    assert bad["x_none.png"] == "Unable to resolve pneumonia subtype from filename : x_none.png"


def test_another_checkpoint_over_an_old_sink_loses_nothing(spark, tmp_path):
    for run in ("one", "two"):
        put(tmp_path / run, **{f"{run}{k}__png": GREY["dark"] for k in range(3)})
        run_for(start_infer(spark, config(tmp_path, incoming=str(tmp_path / run), checkpoint=str(tmp_path / f"c{run}")), MODEL), 120)
    assert tables.predictions(spark, str(tmp_path / "out")).count() == 6


def test_processed_files_are_deleted_after_their_batch(spark, tmp_path):
    put(tmp_path / "zone", **{f"f{k}__png": GREY["dark"] for k in range(4)})
    cfg = config(tmp_path, max_files_per_trigger=1, delete_processed=True)
    run_for(start_infer(spark, cfg, MODEL), 120)
    assert tables.predictions(spark, cfg.output).count() == 4
    assert len(list((tmp_path / "zone").glob("*.png"))) < 4


def test_bounded_run_stops_and_telemetry_is_written(spark, tmp_path):
    put(tmp_path / "zone", a__png=GREY["dark"])
    metrics = str(tmp_path / "metrics")
    listener = watch(spark, metrics)
    try:
        query = start_infer(spark, config(tmp_path, until_drained=False), MODEL)
        assert run_for(query, 8) is False
        assert not query.isActive
        for _ in range(40):
            if tables.metrics(spark, metrics).count():
                break
            time.sleep(0.25)
    finally:
        spark.streams.removeListener(listener)
    row = tables.metrics(spark, metrics).first()
    assert (row.batchId, row.numInputRows) == (0, 1) and row.batchDurationMs > 0
    assert bench_summary(tables.metrics(spark, metrics), 0).first().images == 1


def test_warm_up_leaves_the_sinks_alone(spark, tmp_path):
    cfg = config(tmp_path)
    shared = Path(locate(work_folder(spark, "x"))[1]).parent
    before = {p.name for p in shared.iterdir()} if shared.exists() else set()
    warm_up(spark, cfg, MODEL)
    assert not (tmp_path / "out").exists()
    assert {p.name for p in shared.iterdir()} == before


def test_missing_sinks_have_no_rows(spark, tmp_path):
    assert tables.predictions(spark, str(tmp_path / "none")).count() == 0
    assert tables.metrics(spark, str(tmp_path / "none")).schema == schemas.METRICS


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "sink")
    append_batch(spark.range(3), path, 1, "a")
    append_batch(spark.range(5), path, 2, "a")
    append_batch(spark.range(7), path, 2, "b")
    append_batch(spark.range(4), path, 1, "a")
    counts = spark.read.parquet(path).groupBy("writer", "batch_id").count().orderBy("writer", "batch_id").collect()
    assert counts == [("a", 1, 4), ("a", 2, 5), ("b", 2, 7)]
    append_batch(spark.range(0), path, 1, "a")
    assert spark.read.parquet(path).count() == 12


def test_replay_copies_in_batches(spark, tmp_path):
    source = tmp_path / "source"
    put(source / "train" / "NORMAL", **{f"n{k}__png": GREY["dark"] for k in range(5)})
    put(source / "test" / "PNEUMONIA", p_virus__JPG=b"x" * 10)
    put(source / "other" / "NORMAL", z__png=GREY["dark"])
    files = file_tree(spark, str(source))
    plan = replay_plan(emissions(files, "train"), batch_size=2, limit=0)
    assert sorted(r.batchNo for r in plan.collect()) == [0, 0, 1, 1, 2, 2]
    dest = tmp_path / "zone"
    (dest / "train" / "NORMAL").mkdir(parents=True)
    (dest / "train" / "NORMAL" / "n0.png").write_bytes(b"old")
    started = time.time()
    assert replay(plan, str(dest), interval_seconds=0.2) == 6
    assert time.time() - started > 0.4
    assert (dest / "train" / "NORMAL" / "n0.png").read_bytes() == GREY["dark"]
    assert (dest / "test" / "PNEUMONIA" / "p_virus.JPG").read_bytes() == b"x" * 10
    assert replay_plan(emissions(files, "infer"), 10, limit=3).count() == 3
    names = emissions(files, "infer", unique_names=True).select("relativeTarget").collect()
    assert all(len(r[0].split("_")[0]) == 8 for r in names) and len(names) == 7
    with pytest.raises(ValueError):
        replay(plan.limit(0), str(dest))


def test_deposits_get_fresh_names(spark, tmp_path):
    put(tmp_path / "source", **{f"f{k}__png": GREY["dark"] for k in range(4)})
    files = file_tree(spark, str(tmp_path / "source"))
    for _ in range(2):
        plan = deposit_plan(files, 3, subtype="virus", folder="val/PNEUMONIA")
        assert deposit(plan, str(tmp_path / "zone"), 2) == 3
    names = sorted(p.name for p in (tmp_path / "zone" / "val" / "PNEUMONIA").iterdir())
    assert len(names) == 6 and all("_virus_f" in n for n in names)
    assert not list((tmp_path / "zone" / "_staging").iterdir())


@pytest.mark.parametrize("uri", ["file:/tmp/x", "file:///tmp/x", "/tmp/x"])
def test_local_uris_are_understood(uri):
    assert locate(uri)[1] == "/tmp/x"


def test_runs_of_a_single_key_split_exactly_and_drop_late_rows(spark, tmp_path):
    zone = tmp_path / "rows"
    zone.mkdir()
    # Pauses of 100 s (same run), 100.000001 s (a new run), and a row far behind the watermark in the second file.
    base = 1_700_000_000_000_000
    batches = [
        [0, 5_000_000, 105_000_000, 205_000_001, 5_000_000_000],
        [1_000_000, 5_050_000_000, 9_000_000_000],
        [9_000_000_000],
    ]
    schema = "zone string, at timestamp"
    for number, micros in enumerate(batches):
        rows = spark.createDataFrame([(base + m,) for m in micros], "m long")
        rows = rows.selectExpr("'a' AS zone", "timestamp_micros(m) AS at").union(spark.sql("SELECT 'a', CAST(NULL AS timestamp)"))
        rows.coalesce(1).write.parquet(str(zone / f"n={number}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(zone))
        runs = closed_bucket_runs(stream, "zone", "at", 100, "10 seconds")
        query = runs.writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
        query = query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        kept = sum(operator.numRowsTotal for operator in query.lastProgress.stateOperators)
        assert kept <= 4  # open buckets and sessions, not rows
    done = spark.read.parquet(str(tmp_path / "out"))
    found = done.selectExpr("unix_micros(runStart)", "unix_micros(runEnd)", "rows").collect()
    expected = [(0, 105_000_000, 3), (205_000_001, 205_000_001, 1), (5_000_000_000, 5_050_000_000, 2)]
    assert sorted(map(tuple, found)) == [(base + a, base + b, n) for a, b, n in expected]
    with pytest.raises(ValueError):
        closed_bucket_runs(done, "zone", "runStart", 1, "0 seconds", parts=7)


def outcome_rows(spark, bad):
    good = F.col("id") >= bad
    return spark.range(0, 30, 1, 3).select(
        F.concat(F.lit("/in/"), "id").alias("sourcePath"), F.concat(F.lit("f"), "id").alias("fileName"),
        F.current_timestamp().alias("depositedAt"), F.lit(2).alias("featureWidth"), F.lit(2).alias("featureHeight"),
        F.array(*[F.lit(0.5).cast("float")] * 4).alias("features"), good.alias("ok"), F.when(good, "").otherwise("broken").alias("error"),
    )


@pytest.mark.parametrize("bad", [0, 4, 30])
def test_a_batch_is_counted_by_the_jobs_that_write_it(spark, tmp_path, bad):
    model = lambda: lambda images: np.tile(np.float32([0.2, 0.8]), (len(images), 1))
    output, rejected = f"{tmp_path}/out", f"{tmp_path}/rejected"
    context = spark.sparkContext
    context.setJobGroup(f"batch-{bad}", "one batch")
    try:
        written = write_inferred(outcome_rows(spark, bad), 0, "w", output, rejected, model, 2, 2, names={0: "a", 1: "b"})
        jobs = context.statusTracker().getJobIdsForGroup(f"batch-{bad}")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert written == (30 - bad, bad)
    assert len(jobs) <= 4  # scoring into the cache, a pass over it, and one write to each sink
    assert tables.rejected(spark, rejected).count() == bad


def vectors_table(spark, tmp_path, count):
    rows = spark.range(count).select(
        F.col("id").alias("vec_id"), (F.col("id") % 10).cast("int").alias("label"),
        F.transform(F.sequence(F.lit(1), F.lit(64)), lambda x: (x / 200).cast("float")).alias("embedding"),
    )
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["stream_image_files", "stream_restarted", "stream_train_tree", "stream_cleaned_and_bounded"])
def test_files_of_a_batch_are_listed_by_few_tasks(spark, tmp_path, monkeypatch, name):
    key, tables_at = "spark.sql.sources.parallelPartitionDiscovery.parallelism", vectors_table(spark, tmp_path, 400)
    before, begun, limit = spark.conf.get(key), [], min(64, spark.sparkContext.defaultParallelism)
    for starter in ("start_infer", "start_train"):
        real = getattr(streams, starter)
        monkeypatch.setattr(streams, starter, lambda *a, real=real: begun.append(real(*a)) or begun[-1])
    spark.conf.set(key, "10000")
    try:
        assert getattr(streams, name)(spark, tables_at).count()
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.set(key, before)
    status = spark.sparkContext.statusTracker()
    jobs = [status.getJobInfo(job) for query in begun for job in status.getJobIdsForGroup(str(query.runId))]
    sizes = [status.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
    assert sizes and max(sizes) <= limit


def test_a_bounded_run_ends_where_rows_share_a_file(spark, tmp_path):
    rows = spark.read.parquet(f"{vectors_table(spark, tmp_path / 'once', 20)}/embeddings.parquet")
    rows.union(rows.where("vec_id < 5")).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = []
    runner = threading.Thread(target=lambda: found.append(streams.stream_cleaned_and_bounded(spark, str(tmp_path)).first()), daemon=True)
    runner.start()
    runner.join(90)
    assert [tuple(row) for row in found] == [(18, True, True)]


def test_the_counted_drain_lists_with_few_tasks(spark, tmp_path, monkeypatch):
    key, tables_at, seen = "spark.sql.sources.parallelPartitionDiscovery.parallelism", vectors_table(spark, tmp_path, 10), []

    def reader(session, *options):
        seen.append(int(session.conf.get(key)))
        raise InterruptedError

    monkeypatch.setattr(streams, "stream_reader", reader)
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        with pytest.raises(InterruptedError):
            streams.stream_metrics(spark, tables_at)
        assert seen[0] <= 64 and spark.conf.get(key) == "10000"
    finally:
        spark.conf.set(key, before)


def test_a_source_log_is_not_rewritten_every_ten_batches(spark, tmp_path):
    key = "spark.sql.streaming.fileSource.log.compactInterval"
    put(tmp_path / "zone", **{f"f{k:02}__png": GREY["dark"] for k in range(12)})
    cfg = config(tmp_path, max_files_per_trigger=1)
    for more in (0, 3):
        put(tmp_path / "zone", **{f"g{k:02}__png": GREY["dark"] for k in range(more)})
        with file_stream_settings(spark, cfg.max_files_per_trigger):
            start_infer(spark, cfg, MODEL).awaitTermination()
    log = [p.name for p in (tmp_path / "checkpoint" / "sources" / "0").iterdir() if not p.name.startswith(".")]
    assert len(log) == 15 and not [name for name in log if name.endswith(".compact")]
    names = [r.fileName for r in tables.predictions(spark, cfg.output).collect()]
    assert len(names) == len(set(names)) == 15  # the restart knows what was read
    assert spark.conf.get(key) == "10"


def test_telemetry_that_waits_for_its_query_is_whole(spark, tmp_path):
    """Another query's end does not count, and what a failed write left out is written by the next."""
    listener = MetricsListener(spark, str(tmp_path / "metrics"), query_name="mine")
    mine, other = str(uuid.uuid4()), str(uuid.uuid4())
    event = lambda run, name: SimpleNamespace(runId=run, name=name)
    listener.onQueryStarted(event(other, "other"))
    listener.onQueryStarted(event(mine, "mine"))
    listener.onQueryTerminated(event(other, None))
    assert not listener.wait(0)
    progress = SimpleNamespace(name="mine", batchId=0, numInputRows=3, inputRowsPerSecond=1.0, processedRowsPerSecond=1.0, durationMs={})
    listener.onQueryProgress(SimpleNamespace(progress=progress))
    listener._path, kept = "nowhere://x/y", listener._path
    with pytest.raises(Exception):
        listener.flush()
    listener._path = kept
    listener.onQueryTerminated(event(mine, None))
    assert listener.wait(0)
    assert [r.numInputRows for r in tables.metrics(spark, kept).collect()] == [3]


def test_files_of_a_small_batch_in_a_local_folder_are_looked_up_without_a_job(spark, tmp_path):
    key = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(key)
    zone = tmp_path / "zone" / "train" / "NORMAL"
    put(zone, **{f"g{k:02}__png": GREY["dark"] for k in range(80)})
    cfg = config(tmp_path, max_files_per_trigger=40)
    with file_stream_settings(spark, cfg.max_files_per_trigger, cfg.incoming):
        query = start_train(spark, cfg)
        query.awaitTermination()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))) == 2 * 2  # two writes a batch
    assert tables.features(spark, cfg.output).count() == 80 and spark.conf.get(key) == before
    for many in (0, 5_000):
        with file_stream_settings(spark, many, cfg.incoming):
            assert spark.conf.get(key) == before
