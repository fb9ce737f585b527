"""Figures, distributions and pages shown on a live view of the sinks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.defaults import PAGE_SIZE, QUARANTINE_HEAD
from tidelight.functions.instants import epoch_us, floor_to, latency_seconds, latency_tenths
from tidelight.operators.latency import latency_figures
from tidelight.operators.ordered import ordered_scan, segmented_previous, with_row_index
from tidelight.session import settle

LATENCY = "latencySeconds"


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def bounded_total(df: DataFrame, limit: int | None = None) -> DataFrame:
    """One row: how many rows a run over ``df`` would take; an error when there are none."""
    available = F.count(F.lit(1))
    total = available if not limit or limit < 0 else F.least(available, F.lit(limit).cast("long"))
    empty = F.raise_error(F.lit("No images found"))
    return df.agg(F.when(available > 0, total).otherwise(empty.cast("long")).alias("total"))


def with_latency(df: DataFrame, deposited: str = "depositedAt", processed: str = "processedAt") -> DataFrame:
    return df.withColumn(LATENCY, latency_seconds(F.col(deposited), F.col(processed)))


def positive(label_id: Column) -> Column:
    return F.when(label_id != 0, 1).otherwise(0)


def kpi_summary(predictions: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """One row: predictions, rejected files, share of non-zero classes, exact median latency.

    All figures come from one histogram over tenths of a second, so the median
    needs neither a sort of the rows nor a task that sees all of them.
    """
    tenths = latency_tenths(F.col("depositedAt"), F.col("processedAt"))
    parts = predictions.select(
        tenths.alias("tenths"), positive(F.col("predictedLabelId")).alias("hit"), F.lit(1).alias("good")
    )
    if rejected is not None:
        no_latency = F.lit(None).cast("long")
        parts = parts.unionByName(
            rejected.select(no_latency.alias("tenths"), F.lit(0).alias("hit"), F.lit(0).alias("good"))
        )
    sums = {"predictions": F.col("good"), "rejected": 1 - F.col("good"), "hits": F.col("hit")}
    return latency_figures(parts, sums, {}).select(
        "predictions", "rejected", F.try_divide("hits", "predictions").alias("positiveRate"), "medianLatency"
    )


def class_distribution(df: DataFrame, label: str = "predictedLabel", name: str = "images") -> DataFrame:
    """Rows per class, most frequent first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), label)


def kpi_delta(
    snapshots: DataFrame, order: str, values: Sequence[str], partition: str | None = None
) -> DataFrame:
    """Change of each figure since the snapshot before; NULL when there is none or it is zero.

    ``partition`` names the view a snapshot belongs to; without it all belong to one. A view may hold any share of the
    snapshots: the rows before are found by :func:`segmented_previous`, not by a window over a view.
    """
    segment = partition or "_view"
    placed = snapshots if partition else snapshots.withColumn(segment, F.lit(0))
    known = segmented_previous(placed, segment, [order], values)
    changes = [F.nullif(F.col(v) - F.col(f"{v}_prev"), F.lit(0)).alias(f"{v}Delta") for v in values]
    return known.select(*snapshots.columns, *changes)


def newest_first(df: DataFrame, ts: str = "processedAt", tie: str = "sourcePath") -> DataFrame:
    return df.orderBy(F.desc(ts), tie)


def page_count(df: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    pages = F.greatest(F.lit(1).cast("long"), F.ceil(F.count(F.lit(1)) / size))
    return df.agg(pages.cast("long").alias("pages"))


def existing(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that the table has, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def page(
    df: DataFrame,
    number: int,
    size: int = PAGE_SIZE,
    columns: Sequence[str] | None = None,
    ts: str = "processedAt",
    tie: str = "sourcePath",
    bucket_us: int = 1_000_000,
) -> DataFrame:
    """Page ``number`` (from 1) of the rows, newest first; a number past the end gives the last page.

    A deep page is not found by carrying all rows before it through a top-k:
    a histogram over time says which time range holds the page and how many of
    its rows come first. The rows of that range, with the shown columns only, are
    numbered by a distributed sort.
    """
    shown = existing(df, columns) if columns else df.columns
    backwards = -floor_to(epoch_us(F.col(ts)), bucket_us)
    slots = settle(df.groupBy(backwards.alias("slot")).agg(F.count(F.lit(1)).alias("n")))
    timed_rows = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("n"))), F.lit(0))
    total, known = slots.agg(F.coalesce(F.sum("n"), F.lit(0)), timed_rows).first()
    pages = max(1, math.ceil(total / size))
    start = (min(max(number, 1), pages) - 1) * size
    stop = min(start + size, total)

    scanned = ordered_scan(slots.where("slot IS NOT NULL"), "slot", bucket_us, running=["n"])
    inside = (F.col("n_run") > start) & (F.col("n_run") - F.col("n") < stop)
    span = scanned.where(inside).agg(
        F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.min(F.col("n_run") - F.col("n")).alias("before")
    ).first()
    if span.lo is None:  # nothing but rows without a time: they come last
        narrowed, skip = df.where(F.col(ts).isNull()), start - known
    else:
        timed = (epoch_us(F.col(ts)) >= -span.hi) & (epoch_us(F.col(ts)) < -span.lo + bucket_us)
        narrowed = df.where(timed | F.col(ts).isNull()) if stop > known else df.where(timed)
        skip = start - span.before
    narrowed = narrowed.select(*dict.fromkeys([*shown, ts, tie]))
    numbered = with_row_index(narrowed, F.desc(ts), F.col(tie).asc(), name="_row")
    wanted = (F.col("_row") >= skip) & (F.col("_row") < skip + size)
    return newest_first(numbered.where(wanted), ts, tie).select(*shown)


def quarantine_head(df: DataFrame, n: int = QUARANTINE_HEAD, ts: str = "processedAt", tie: str = "sourcePath") -> DataFrame:
    """The newest quarantined files with their error."""
    return newest_first(df, ts, tie).limit(n).select("fileName", "error")


def processed_names(*frames: DataFrame | None, key: str = "fileName") -> DataFrame | None:
    """Distinct keys of all frames that have the column."""
    result = None
    for df in frames:
        if df is None or key not in df.columns:
            continue
        result = df.select(key) if result is None else result.union(df.select(key))
    return None if result is None else result.distinct()


def backlog(landing: DataFrame, *processed: DataFrame | None, key: str = "fileName") -> DataFrame:
    """Distinct landing keys that no processed frame has.

    Both sides are reduced to distinct keys on the map side first, so a key with
    many copies costs one row per task, and the join reuses that partitioning.
    """
    waiting = landing.select(key).distinct()
    done = processed_names(*processed, key=key)
    return waiting if done is None else waiting.join(done, key, "left_anti")


def rejected_per_batch(outcomes: DataFrame, batch: str = "batchId") -> DataFrame:
    return outcomes.groupBy(batch).agg(F.count_if(~F.col("ok")).alias("rejected"))


def accuracy(df: DataFrame, truth: str = "labelId", predicted: str = "predictedLabelId") -> DataFrame:
    correct = F.count_if(F.col(truth) == F.col(predicted))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        correct.alias("correct"),
        F.try_divide(correct, F.count(F.lit(1))).alias("accuracy"),
    )
