"""Figures over the micro-batch telemetry table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelight.defaults import METRICS_TAIL, WARMUP_BATCHES


def nonempty_batches(df: DataFrame) -> DataFrame:
    return df.where("numInputRows > 0")


def metrics_tail(df: DataFrame, n: int = METRICS_TAIL, ts: str = "timestamp") -> DataFrame:
    """The newest ``n`` batches."""
    return df.orderBy(F.desc(ts), F.desc("batchId")).limit(n)


def last_batch(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The newest batch as one row."""
    return metrics_tail(df, 1, ts)


def after_warmup(df: DataFrame, skip: int = WARMUP_BATCHES, ts: str = "timestamp") -> DataFrame:
    """All batches but the first ``skip``, by time and then batch id.

    The last skipped batch is found by a top-k, so no global numbering is needed.
    """
    if skip <= 0:
        return df
    place = F.struct(ts, "batchId")
    warm = df.select(place.alias("place")).orderBy("place").limit(skip)
    return df.where(place > warm.agg(F.max("place")).scalar())


def bench_summary(df: DataFrame, skip: int = WARMUP_BATCHES, ts: str = "timestamp") -> DataFrame:
    """Steady batches, their rows, and the mean rate per second and per minute."""
    rate = F.avg("processedRowsPerSecond")
    return after_warmup(df, skip, ts).agg(
        F.count(F.lit(1)).alias("steadyBatches"),
        F.coalesce(F.sum("numInputRows"), F.lit(0)).alias("images"),
        rate.alias("imagesPerSecond"),
        (rate * 60).alias("imagesPerMinute"),
    )
