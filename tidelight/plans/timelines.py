"""Queue, throughput and runs over the predictions' two clocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelight.operators import timeline
from tidelight.plans import inputs as i
from tidelight.plans.catalog import Catalog

PLANS = Catalog()

_EVENTS = f"""{i.PREDICTIONS}, steps AS (SELECT "depositedAt" AS t, 1 AS delta FROM predictions
  UNION ALL SELECT "processedAt", -1 FROM predictions),
net AS (SELECT t, sum(delta) AS d FROM steps WHERE t IS NOT NULL GROUP BY 1),
levels AS (SELECT t, CAST(sum(d) OVER (ORDER BY t) AS BIGINT) AS level FROM net)"""


def _grid(sql_ts: str, table: str = "predictions") -> str:
    return f"""counts AS (SELECT date_trunc('hour', {sql_ts}) AS h, count(*) AS n FROM {table} GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT min(h) FROM counts), (SELECT max(h) FROM counts), INTERVAL 1 HOUR)) AS h)
SELECT CAST(grid.h AS TIMESTAMP) AS {sql_ts}, coalesce(n, 0) AS images FROM grid LEFT JOIN counts ON grid.h = counts.h
ORDER BY grid.h DESC LIMIT 600"""


@PLANS.add(f"""WITH {_EVENTS},
hourly AS (SELECT date_trunc('hour', t) AS h, arg_max(level, t) AS level FROM levels GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT min(h) FROM hourly), (SELECT max(h) FROM hourly), INTERVAL 1 HOUR)) AS h)
SELECT CAST(grid.h AS TIMESTAMP) AS t, last_value(level IGNORE NULLS) OVER (ORDER BY grid.h) AS level
FROM grid LEFT JOIN hourly ON grid.h = hourly.h""")
def queue_level(spark, sf_dir):
    return timeline.queue_level(timeline.queue_events([i.predictions(spark, sf_dir)]), "1 hour")


@PLANS.add(f"""WITH {_EVENTS},
seconds AS (SELECT date_trunc('second', t) AS s, arg_max(level, t) AS level FROM levels GROUP BY 1),
grid AS (SELECT unnest(generate_series((SELECT max(s) FROM seconds) - INTERVAL 599 SECOND,
  (SELECT max(s) FROM seconds), INTERVAL 1 SECOND)) AS s)
SELECT CAST(g.s AS TIMESTAMP) AS t, (SELECT arg_max(level, seconds.s) FROM seconds WHERE seconds.s <= g.s) AS level
FROM grid g""")
def queue_level_tail(spark, sf_dir):
    """The chart of the newest 600 seconds."""
    return timeline.queue_level(timeline.queue_events([i.predictions(spark, sf_dir)]), "1 second", last=600)


@PLANS.add(f"""WITH {_EVENTS} SELECT t, level FROM levels""")
def queue_changes(spark, sf_dir):
    good, bad = i.sinks(spark, sf_dir)
    return timeline.queue_changes(timeline.queue_events([good, None, bad]))


@PLANS.add(f"""WITH {i.PREDICTIONS}, {_grid('"depositedAt"')}""")
def deposits_per_bucket(spark, sf_dir):
    return timeline.events_per_bucket(i.predictions(spark, sf_dir), "depositedAt", "1 hour")


@PLANS.add(f"""WITH {i.PREDICTIONS}, {_grid('"processedAt"')}""")
def processed_per_bucket(spark, sf_dir):
    return timeline.events_per_bucket(i.predictions(spark, sf_dir), "processedAt", "1 hour")


@PLANS.add(f"""WITH {i.PREDICTIONS}, instants AS (SELECT DISTINCT "processedAt" FROM predictions)
SELECT "processedAt", (epoch_us("processedAt") - epoch_us(lag("processedAt") OVER (ORDER BY "processedAt"))) / 1000000.0
  AS "gapSeconds" FROM instants""")
def event_gaps(spark, sf_dir):
    return timeline.event_gaps(i.predictions(spark, sf_dir), "processedAt")


def _runs(gap_seconds: int, rows: str = "predictions") -> str:
    return f"""{i.PREDICTIONS}, gaps AS (SELECT *, "processedAt" - lag("processedAt") OVER (ORDER BY "processedAt", event_id)
  > INTERVAL {gap_seconds} SECOND AS pause FROM {rows}),
numbered AS (SELECT *, CAST(1 + sum(CASE WHEN pause THEN 1 ELSE 0 END) OVER (ORDER BY "processedAt", event_id
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "runId" FROM gaps)"""


_RUNS = _runs(600)
# Without their fifteenth day the events are two long runs, told apart by a pause of six hours or more.
_TWO_RUNS = _runs(21_600, """(SELECT * FROM predictions WHERE day("processedAt") <> 15)""")


def _two_runs(spark, sf_dir):
    return i.predictions(spark, sf_dir).where("day(processedAt) <> 15")


@PLANS.add(f"""WITH {_RUNS} SELECT "runId", min("processedAt") AS "runStart", max("processedAt") AS "runEnd",
  count(*) AS rows FROM numbered GROUP BY 1""")
def runs(spark, sf_dir):
    return timeline.runs(i.predictions(spark, sf_dir), gap_seconds=600)


@PLANS.add(f"""WITH {_RUNS} SELECT event_id, "runId" FROM numbered""")
def run_of_each_row(spark, sf_dir):
    rows = i.predictions(spark, sf_dir)
    return timeline.assign_runs(rows, gap_seconds=600, spread_by="event_id").select("event_id", "runId")


@PLANS.add(f"""WITH {_TWO_RUNS} SELECT event_id, "processedAt" FROM numbered
WHERE "runId" = (SELECT max("runId") FROM numbered)""")
def last_run_rows(spark, sf_dir):
    return timeline.last_run_rows(_two_runs(spark, sf_dir), gap_seconds=21_600).select("event_id", "processedAt")


@PLANS.add(f"""WITH {_TWO_RUNS}, facts AS (SELECT count(*) AS images,
  greatest((epoch_us(max("depositedAt")) - epoch_us(min("depositedAt"))) / 1000000.0, 1.0) AS "depositSeconds",
  greatest((epoch_us(max("processedAt")) - epoch_us(min("depositedAt"))) / 1000000.0, 1.0) AS "totalSeconds",
  median(round_even((epoch_us("processedAt") - epoch_us("depositedAt")) / 100000.0, 0) / 10) AS "medianLatency"
  FROM numbered WHERE "runId" = (SELECT max("runId") FROM numbered))
SELECT *, images / "depositSeconds" AS "depositRate", images / "totalSeconds" AS "totalRate" FROM facts""")
def last_run_kpis(spark, sf_dir):
    return timeline.last_run_kpis(_two_runs(spark, sf_dir), gap_seconds=21_600)


@PLANS.add(f"""WITH {i.PREDICTIONS}, {_grid('"processedAt"').replace("ORDER BY grid.h DESC LIMIT 600", "")}""")
def processed_whole_history(spark, sf_dir):
    """No tail: every bucket from the first to the last."""
    counts = timeline.events_per_bucket(i.predictions(spark, sf_dir), "processedAt", "1 hour", last=None)
    return counts.select("processedAt", F.col("images"))
