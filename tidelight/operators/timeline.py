"""Queue levels, tumbling counts and run detection over deposit and processing times."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.defaults import CHART_BUCKETS, RUN_GAP_SECONDS
from tidelight.functions.instants import (
    bucket_us,
    epoch_us,
    floor_to,
    from_epoch_us,
    latency_tenths,
    micros_in,
    type_of,
)
from tidelight.operators.latency import latency_figures
from tidelight.operators.ordered import ordered_scan, salted_lookup
from tidelight.session import settle

# Steps of a filled gap that one generator row may emit.
_FILL_BLOCK = 4_096
_US_PER_SECOND = 1_000_000


def queue_events(
    frames: Iterable[DataFrame | None], deposited: str = "depositedAt", processed: str = "processedAt"
) -> DataFrame | None:
    """+1 at each deposit and -1 at each processing time, as ``(t, delta)``.

    Frames that are absent or lack the two columns are skipped, and so are NULL
    times. Each frame is scanned once. Returns ``None`` when no frame is usable.
    """
    result = None
    for df in frames:
        if df is None or not {deposited, processed} <= set(df.columns):
            continue
        steps = F.array(
            F.struct(F.col(deposited).alias("t"), F.lit(1).alias("delta")),
            F.struct(F.col(processed).alias("t"), F.lit(-1).alias("delta")),
        )
        part = df.select(F.inline(steps)).na.drop(subset=["t"])
        result = part if result is None else result.unionByName(part)
    return result


def queue_changes(events: DataFrame) -> DataFrame:
    """Queue level after the last event of each distinct instant: ``(t, level)``."""
    kind = type_of(events, "t")
    net = events.groupBy(epoch_us(F.col("t")).alias("us")).agg(F.sum("delta").alias("net"))
    scanned = ordered_scan(settle(net), "us", running=["net"], levels=2)
    return scanned.select(from_epoch_us(F.col("us"), kind).alias("t"), F.col("net_run").alias("level"))


def queue_level(events: DataFrame, bucket: str = "1 second", last: int | None = None) -> DataFrame:
    """Queue level at the end of every bucket from the first event to the last: ``(t, level)``.

    Buckets without events carry the level before them. ``last`` keeps only the
    newest buckets; the others are dropped before the grid is laid.
    """
    kind, width = type_of(events, "t"), micros_in(bucket)
    net = events.groupBy(bucket_us(F.col("t"), width).alias("us")).agg(F.sum("delta").alias("net"))
    net = net.withColumn("at", F.col("us"))
    scanned = ordered_scan(net, "us", width, running=["net"], following=["at"])
    until = F.coalesce(F.col("at_next"), F.col("us") + width)
    steps = scanned.select("us", until.alias("until"), F.col("net_run").alias("level"))
    if last is not None:
        newest = net.agg((F.max("us") - (last - 1) * width).alias("us"))
        first = newest.scalar()
        steps = steps.where(F.col("until") > first).withColumn("us", F.greatest("us", first))
    count = (F.col("until") - F.col("us")) / width
    blocks = steps.withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / _FILL_BLOCK)))
    )
    start = F.col("us") + F.col("block") * (_FILL_BLOCK * width)
    stop = F.least(start + (_FILL_BLOCK - 1) * width, F.col("until") - width)
    grid = blocks.withColumn("slot", F.explode(F.sequence(start, stop, F.lit(width))))
    return grid.select(from_epoch_us(F.col("slot"), kind).alias("t"), "level")


def events_per_bucket(
    df: DataFrame, ts: str, bucket: str = "1 second", last: int | None = CHART_BUCKETS, count_name: str = "images"
) -> DataFrame:
    """Rows per tumbling bucket, zero-filled, for the newest ``last`` buckets or, with None, for all."""
    kind, width = type_of(df, ts), micros_in(bucket)
    # Written once: the grid's bounds and the counts come from one scan of ``df``.
    counts = settle(
        df.na.drop(subset=[ts]).groupBy(bucket_us(F.col(ts), width).alias("us")).agg(F.count(F.lit(1)).alias("n"))
    )
    span = counts.agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
    first = F.col("lo") if last is None else F.greatest(F.col("lo"), F.col("hi") - (last - 1) * width)
    # One row per block of the grid, which are spread before they are laid out.
    block = _FILL_BLOCK * width
    blocks = span.where("hi IS NOT NULL").select(F.explode(F.sequence(first, F.col("hi"), F.lit(block))).alias("start"), "hi")
    stop = F.least(F.col("start") + (block - width), F.col("hi"))
    grid = blocks.repartition("start").select(F.explode(F.sequence("start", stop, F.lit(width))).alias("us"))
    filled = grid.join(counts, "us", "left")
    return filled.select(
        from_epoch_us(F.col("us"), kind).alias(ts), F.coalesce("n", F.lit(0)).cast("long").alias(count_name)
    )


def event_gaps(df: DataFrame, ts: str) -> DataFrame:
    """Distinct instants with the seconds since the instant before: ``(ts, gapSeconds)``."""
    kind = type_of(df, ts)
    instants = settle(df.na.drop(subset=[ts]).select(epoch_us(F.col(ts)).alias("us")).distinct())
    scanned = ordered_scan(instants.withColumn("at", F.col("us")), "us", previous=["at"], levels=2)
    gap = (F.col("us") - F.col("at_prev")) / F.lit(1_000_000.0)
    return scanned.select(from_epoch_us(F.col("us"), kind).alias(ts), gap.alias("gapSeconds"))


def _run_buckets(df: DataFrame, ts: str, gap_seconds: float) -> DataFrame:
    """One row per non-empty bucket of gap width; ``starts`` is 1 where a run begins.

    A pause longer than the gap cannot lie inside such a bucket, so runs begin
    only at the first event of a bucket.
    """
    gap = int(gap_seconds * _US_PER_SECOND)
    us = epoch_us(F.col(ts))
    # Written once: several steps read these few rows, none of them ``df`` again.
    buckets = settle(
        df.na.drop(subset=[ts])
        .groupBy(floor_to(us, gap).alias("bucket"))
        .agg(F.min(us).alias("first"), F.max(us).alias("last"), F.count(F.lit(1)).alias("n"))
    )
    scanned = ordered_scan(buckets, "bucket", gap, previous=["last"])
    pause = F.col("first") - F.col("last_prev")
    return scanned.withColumn("starts", (F.coalesce(pause > gap, F.lit(True))).cast("long"))


def _numbered_run_buckets(df: DataFrame, ts: str, gap_seconds: float) -> DataFrame:
    gap = int(gap_seconds * _US_PER_SECOND)
    buckets = _run_buckets(df, ts, gap_seconds).select("bucket", "first", "last", "n", "starts")
    return ordered_scan(buckets, "bucket", gap, running=["starts"]).withColumnRenamed("starts_run", "runId")


def runs(df: DataFrame, ts: str = "processedAt", gap_seconds: float = RUN_GAP_SECONDS) -> DataFrame:
    """Runs separated by pauses longer than the gap: ``(runId, runStart, runEnd, rows)``."""
    kind = type_of(df, ts)
    return (
        _numbered_run_buckets(df, ts, gap_seconds)
        .groupBy("runId")
        .agg(
            from_epoch_us(F.min("first"), kind).alias("runStart"),
            from_epoch_us(F.max("last"), kind).alias("runEnd"),
            F.sum("n").alias("rows"),
        )
    )


def assign_runs(
    df: DataFrame, ts: str = "processedAt", gap_seconds: float = RUN_GAP_SECONDS, spread_by: str | None = None
) -> DataFrame:
    """Add ``runId`` to each row with a time; ``spread_by`` should differ between rows."""
    gap = int(gap_seconds * _US_PER_SECOND)
    table = _numbered_run_buckets(df, ts, gap_seconds).select("bucket", "runId")
    placed = df.na.drop(subset=[ts]).withColumn("bucket", bucket_us(F.col(ts), gap))
    return salted_lookup(placed, table, "bucket", spread_by or ts).drop("bucket")


def last_run_start(df: DataFrame, ts: str = "processedAt", gap_seconds: float = RUN_GAP_SECONDS) -> DataFrame:
    """One row: the first instant of the newest run."""
    kind = type_of(df, ts)
    began = F.max(F.when(F.col("starts") == 1, F.col("first")))
    return _run_buckets(df, ts, gap_seconds).agg(from_epoch_us(began, kind).alias("runStart"))


def last_run_rows(df: DataFrame, ts: str = "processedAt", gap_seconds: float = RUN_GAP_SECONDS) -> DataFrame:
    return df.where(F.col(ts) >= last_run_start(df, ts, gap_seconds).scalar())


def last_run_kpis(
    df: DataFrame,
    deposited: str = "depositedAt",
    processed: str = "processedAt",
    gap_seconds: float = RUN_GAP_SECONDS,
) -> DataFrame:
    """Volume, spans, rates and median latency of the newest run; spans count at least one second."""
    tenths = latency_tenths(F.col(deposited), F.col(processed))
    rows = last_run_rows(df, processed, gap_seconds).select(
        tenths.alias("tenths"), epoch_us(F.col(deposited)).alias("d"), epoch_us(F.col(processed)).alias("p")
    )
    figures = latency_figures(
        rows, {"images": F.lit(1)}, {"firstIn": -F.col("d"), "lastIn": F.col("d"), "lastOut": F.col("p")}
    )

    def seconds_until(end: str) -> Column:
        return F.greatest((F.col(end) + F.col("firstIn")) / F.lit(1_000_000.0), F.lit(1.0))

    facts = figures.select(
        "images",
        seconds_until("lastIn").alias("depositSeconds"),
        seconds_until("lastOut").alias("totalSeconds"),
        "medianLatency",
    )
    return facts.withColumns(
        {
            "depositRate": F.col("images") / F.col("depositSeconds"),
            "totalRate": F.col("images") / F.col("totalSeconds"),
        }
    )
