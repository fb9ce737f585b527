"""Live-view figures over predictions, quarantine and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelight.defaults import LOCAL_ZONE
from tidelight.functions.instants import to_local
from tidelight.operators import batches, history, kpi
from tidelight.plans import inputs as i
from tidelight.plans.catalog import Catalog
from tidelight.session import settle, work_folder
from tidelight.sinks.tables import append_batch, overwrite, write_report
from tidelight.sources.tables import read_sink

PLANS = Catalog()

_TENTHS = """round_even((epoch_us("processedAt") - epoch_us("depositedAt")) / 100000.0, 0)"""


@PLANS.add(f"""WITH {i.PREDICTIONS}, good AS (SELECT *, {_TENTHS} / 10 AS latency FROM predictions
  WHERE event_type <> 'error')
SELECT count(*) AS predictions, (SELECT count(*) FROM predictions WHERE event_type = 'error') AS rejected,
  avg(CASE WHEN "predictedLabelId" <> 0 THEN 1.0 ELSE 0.0 END) AS "positiveRate",
  median(latency) AS "medianLatency" FROM good""")
def kpi_summary(spark, sf_dir):
    good, bad = i.sinks(spark, sf_dir)
    return kpi.kpi_summary(good, bad).withColumn("positiveRate", F.col("positiveRate").cast("double"))


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT event_id, {_TENTHS} / 10 AS "latencySeconds" FROM predictions""")
def prediction_latency(spark, sf_dir):
    return kpi.with_latency(i.predictions(spark, sf_dir)).select("event_id", kpi.LATENCY)


@PLANS.add(f"""WITH {i.PREDICTIONS}
SELECT event_id, "processedAt" AT TIME ZONE 'UTC' AT TIME ZONE '{LOCAL_ZONE}' AS "localTime" FROM predictions""")
def local_times(spark, sf_dir):
    rows = i.predictions(spark, sf_dir)
    return rows.select("event_id", to_local(F.col("processedAt"), LOCAL_ZONE).cast("timestamp_ntz").alias("localTime"))


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT count(*) AS rows FROM predictions""")
def row_count(spark, sf_dir):
    return kpi.row_count(i.predictions(spark, sf_dir))


@PLANS.add("""SELECT least(count(*), 5000) AS total FROM events""")
def bounded_total(spark, sf_dir):
    return kpi.bounded_total(i.paths(spark, sf_dir), 5000)


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT "predictedLabel", count(*) AS images FROM predictions GROUP BY 1""")
def class_distribution(spark, sf_dir):
    return kpi.class_distribution(i.predictions(spark, sf_dir))


@PLANS.add("""WITH daily AS (SELECT event_type AS view, date_trunc('day', ts) AS day, count(*) AS n,
    count(*) FILTER (WHERE value > 100) AS slow FROM events GROUP BY 1, 2)
SELECT view, CAST(day AS TIMESTAMP) AS day, n, slow,
  nullif(n - lag(n) OVER w, 0) AS "nDelta", nullif(slow - lag(slow) OVER w, 0) AS "slowDelta"
FROM daily WINDOW w AS (PARTITION BY view ORDER BY day)""")
def kpi_delta(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    daily = i.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("view"), day.alias("day"))
    snapshots = daily.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 100).alias("slow"))
    return kpi.kpi_delta(snapshots, "day", ["n", "slow"], partition="view")


@PLANS.add("""WITH shots AS (SELECT event_id, event_id AS n, CAST(floor(value) AS BIGINT) AS slow FROM events)
SELECT *, nullif(n - lag(n) OVER w, 0) AS "nDelta", nullif(slow - lag(slow) OVER w, 0) AS "slowDelta" FROM shots
WINDOW w AS (ORDER BY event_id)""")
def kpi_delta_one_view(spark, sf_dir):
    """One view that holds every snapshot."""
    value = F.floor("value").cast("long").alias("slow")
    snapshots = i.table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("n"), value)
    return kpi.kpi_delta(snapshots, "event_id", ["n", "slow"])


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT "sourcePath", "processedAt" FROM predictions""")
def newest_first(spark, sf_dir):
    return kpi.newest_first(i.predictions(spark, sf_dir)).select("sourcePath", "processedAt")


_PAGE = f"""WITH {i.PREDICTIONS} SELECT "processedAt", "fileName", "predictedLabel", {_TENTHS} / 10 AS "latencySeconds"
FROM predictions ORDER BY "processedAt" DESC, "sourcePath" """
_SHOWN = ["processedAt", "fileName", "predictedLabel", "score", kpi.LATENCY]


@PLANS.add(_PAGE + "LIMIT 20 OFFSET 40")
def predictions_page(spark, sf_dir):
    """A page is a limit by definition."""
    return kpi.page(kpi.with_latency(i.predictions(spark, sf_dir)), 3, 20, columns=_SHOWN)


@PLANS.add(_PAGE + "LIMIT 30 OFFSET (SELECT (greatest(1, CAST(ceil(count(*) / 30.0) AS BIGINT)) - 1) * 30 FROM events)")
def predictions_last_page(spark, sf_dir):
    """A page number past the end gives the last page."""
    return kpi.page(kpi.with_latency(i.predictions(spark, sf_dir)), 10**9, 30, columns=_SHOWN)


@PLANS.add("""SELECT greatest(1, CAST(ceil(count(*) / 20.0) AS BIGINT)) AS pages FROM events""")
def page_count(spark, sf_dir):
    return kpi.page_count(i.predictions(spark, sf_dir))


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT "fileName", 'cannot decode ' || "fileName" AS error FROM predictions
WHERE event_type = 'error' ORDER BY "processedAt" DESC, "sourcePath" LIMIT 10""")
def quarantine_head(spark, sf_dir):
    """The view shows ten rows of the quarantine."""
    return kpi.quarantine_head(i.sinks(spark, sf_dir)[1])


@PLANS.add("""SELECT DISTINCT concat('f', event_id, '.jpeg') AS "fileName" FROM events
WHERE event_type IN ('view', 'click', 'error')""")
def processed_names(spark, sf_dir):
    good, bad = i.sinks(spark, sf_dir)
    return kpi.processed_names(good.where("event_type IN ('view', 'click')"), bad)


@PLANS.add("""SELECT concat('f', event_id, '.jpeg') AS "fileName" FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events p WHERE p.event_type IN ('view', 'click', 'error') AND p.event_id = e.event_id)""")
def backlog(spark, sf_dir):
    """Every event's file landed; those of views and clicks are predicted, those of errors rejected."""
    landing = i.predictions(spark, sf_dir)
    good, bad = i.sinks(spark, sf_dir)
    return kpi.backlog(landing, good.where("event_type IN ('view', 'click')"), bad)


@PLANS.add("""SELECT concat('f', event_id, '.jpeg') AS "fileName", phase FROM events e, (SELECT unnest(['before', 'after']) AS phase)
WHERE event_type <> 'view' AND (phase = 'before' OR event_type NOT IN ('click', 'error'))""")
def backlog_history(spark, sf_dir):
    """The backlog against bucketed names: after the views were processed, and after clicks and errors too."""
    landing = i.predictions(spark, sf_dir)
    good, bad = i.sinks(spark, sf_dir)
    folder = work_folder(spark, "names")
    table = f"processed_{folder[-32:]}"
    history.open_history(spark, table, folder)
    try:
        history.remember(table, good.where("event_type = 'view'"))
        first = settle(history.backlog_since(landing, table).withColumn("phase", F.lit("before")))
        history.remember(table, good.where("event_type = 'click'"), bad)
        return first.unionByName(settle(history.backlog_since(landing, table).withColumn("phase", F.lit("after"))))
    finally:
        spark.sql(f"DROP TABLE {table}")


@PLANS.add("""SELECT CAST(floor(event_id / 100) AS BIGINT) AS "batchId",
  count(*) FILTER (WHERE event_type = 'error') AS rejected FROM events GROUP BY 1""")
def rejected_per_batch(spark, sf_dir):
    events = i.table(spark, sf_dir, "events")
    outcomes = events.select(
        F.floor(F.col("event_id") / 100).cast("long").alias("batchId"), (F.col("event_type") != "error").alias("ok")
    )
    return kpi.rejected_per_batch(outcomes)


@PLANS.add(f"""WITH {i.METRICS}, ranked AS (SELECT *, row_number() OVER (ORDER BY "timestamp", "batchId") AS n FROM metrics)
SELECT count(*) AS "steadyBatches", CAST(sum("numInputRows") AS BIGINT) AS images,
  round(avg("processedRowsPerSecond"), 6) AS "imagesPerSecond",
  round(avg("processedRowsPerSecond") * 60, 6) AS "imagesPerMinute" FROM ranked WHERE n > 2""")
def bench_summary(spark, sf_dir):
    summary = batches.bench_summary(i.metrics(spark, sf_dir))
    return summary.withColumns({c: F.round(c, 6) for c in ("imagesPerSecond", "imagesPerMinute")})


@PLANS.add(f"""WITH {i.METRICS} SELECT * FROM metrics ORDER BY "timestamp" DESC, "batchId" DESC LIMIT 1""")
def last_batch(spark, sf_dir):
    return batches.last_batch(i.metrics(spark, sf_dir))


@PLANS.add(f"""WITH {i.METRICS} SELECT * FROM metrics ORDER BY "timestamp" DESC, "batchId" DESC LIMIT 200""")
def metrics_tail(spark, sf_dir):
    """The telemetry view shows the newest 200 batches."""
    return batches.metrics_tail(i.metrics(spark, sf_dir))


@PLANS.add("""WITH minutes AS (SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (WHERE event_type = 'click')
  AS "numInputRows" FROM events GROUP BY 1)
SELECT CAST(hour AS TIMESTAMP) AS hour, "numInputRows" FROM minutes WHERE "numInputRows" > 0""")
def nonempty_batches(spark, sf_dir):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    hourly = i.table(spark, sf_dir, "events").groupBy(hour.alias("hour"))
    clicks = hourly.agg(F.count_if(F.col("event_type") == "click").alias("numInputRows"))
    return batches.nonempty_batches(clicks)


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT "predictedLabel", count(*) AS images FROM predictions GROUP BY 1""")
def replayed_sink(spark, sf_dir):
    """Writing the same micro-batch twice leaves its rows once; writing it empty leaves none."""
    rows = i.predictions(spark, sf_dir).select("sourcePath", "predictedLabel")
    sink = work_folder(spark, "sink")
    append_batch(rows, sink, 7, "one")
    append_batch(rows, sink, 8, "one")
    append_batch(rows, sink, 7, "one")
    append_batch(rows.limit(0), sink, 8, "one")
    return kpi.class_distribution(read_sink(spark, sink, rows.schema))


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT count(*) AS rows FROM predictions WHERE event_type <> 'error'""")
def overwritten_sink(spark, sf_dir):
    """A batch overwrite replaces what was there."""
    sink = work_folder(spark, "sink")
    good, bad = i.sinks(spark, sf_dir)
    overwrite(bad.select("sourcePath"), sink)
    overwrite(good.select("sourcePath"), sink)
    return kpi.row_count(spark.read.parquet(sink))


@PLANS.add(f"""WITH {i.PREDICTIONS} SELECT count(*) AS total,
  count(*) FILTER (WHERE "predictedLabelId" = event_id % 5) AS correct,
  count(*) FILTER (WHERE "predictedLabelId" = event_id % 5) / count(*) AS accuracy FROM predictions""")
def accuracy_report(spark, sf_dir):
    """Accuracy written as JSON and read back."""
    rows = i.predictions(spark, sf_dir).withColumn("labelId", F.col("event_id") % 5)
    report = kpi.accuracy(rows)
    folder = work_folder(spark, "report")
    write_report(report, folder)
    return spark.read.schema(report.schema).json(folder)
