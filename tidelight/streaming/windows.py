"""Streaming forms of the time-bucket counts and of run detection.

The table forms are in :mod:`tidelight.operators.timeline`. Here state is kept
per open bucket or run only, and the watermark says when it can be dropped, so
``delay`` must cover how late a row may arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_counts(stream: DataFrame, ts: str, bucket: str, delay: str, count_name: str = "images") -> DataFrame:
    """Rows per tumbling bucket; empty buckets have no row."""
    windows = stream.withWatermark(ts, delay).groupBy(F.window(ts, bucket))
    counts = windows.agg(F.count(F.lit(1)).alias(count_name))
    return counts.select(F.col("window.start").alias(ts), count_name)


def closed_runs(stream: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Runs of each key separated by pauses longer than the gap, each once it can no longer grow (append mode).

    Spark keeps session state per key; the key may be the landing zone or the consumer.
    """
    windows = stream.withWatermark(ts, delay).groupBy(key, F.session_window(ts, gap))
    return windows.agg(
        F.min(ts).alias("runStart"), F.max(ts).alias("runEnd"), F.count(F.lit(1)).alias("rows")
    ).drop("session_window")


def closed_bucket_runs(
    stream: DataFrame, key: str, ts: str, gap_seconds: int, delay: str, parts: int = 10
) -> DataFrame:
    """:func:`closed_runs` for keys that hold most rows: the session state sees one row per key and bucket.

    Two chained stateful operators in append mode. Tumbling buckets of a ``parts``-th of the gap keep first row,
    last row and count, after map-side combining, so neither a hot key nor a hot bucket gathers rows. Closed
    buckets then form sessions wide enough never to cut a run, and each closed session is split where the exact
    pause between two buckets is longer than the gap. A run is written once its session has ended, at most three
    buckets later than by itself, unless further runs follow within that time.

    Rows later than ``delay`` are dropped by the watermark before the buckets. Null instants have no bucket.
    """
    micros = gap_seconds * 1_000_000
    if parts < 1 or micros % parts:
        raise ValueError("the gap must be a whole number of buckets")
    bucket = micros // parts
    at = F.unix_micros(ts)
    buckets = stream.withWatermark(ts, delay).groupBy(key, F.window(ts, f"{bucket} microseconds"))
    summaries = buckets.agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("rows"))
    # Two rows of a run lie in buckets whose ends differ by the gap at most; half a bucket more decides no tie.
    closed = summaries.withColumn("closed", F.window_time("window"))
    sessions = closed.groupBy(key, F.session_window("closed", f"{micros + bucket // 2} microseconds"))
    listed = sessions.agg(F.array_sort(F.collect_list(F.struct("first", "last", "rows"))).alias("buckets"))

    begins = F.filter(
        F.sequence(F.lit(1), F.size("buckets")),
        lambda n: (n == 1) | (F.get("buckets", n - 1)["first"] - F.get("buckets", n - 2)["last"] > micros),
    )
    split = listed.select(key, "buckets", begins.alias("begins"))

    def run(begin: Column, number: Column) -> Column:
        end = F.coalesce(F.get("begins", number + 1), F.size("buckets") + 1)
        rows = F.aggregate(F.slice("buckets", begin, end - begin), F.lit(0).cast("long"), lambda acc, b: acc + b["rows"])
        return F.struct(
            F.timestamp_micros(F.get("buckets", begin - 1)["first"]).alias("runStart"),
            F.timestamp_micros(F.get("buckets", end - 2)["last"]).alias("runEnd"),
            rows.alias("rows"),
        )

    return split.select(key, F.inline(F.transform("begins", run)))
