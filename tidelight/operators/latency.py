"""Histogram over tenths of a second, from which the exact median is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelight.operators.ordered import median_position, ordered_scan
from tidelight.session import settle

# Where rows without a latency go; no real latency is this negative.
_NOWHERE = -(2**53)


def latency_figures(df: DataFrame, sums: dict[str, Column], highest: dict[str, Column]) -> DataFrame:
    """One row: the given sums and maxima over all rows, and ``medianLatency`` in seconds.

    Rows whose ``tenths`` is NULL form one group of their own: they count for
    the sums but not for the median. ``df`` is read once, into a small table
    with a row per tenth of a second; ranks and figures come from that table.
    """
    place = F.coalesce("tenths", F.lit(_NOWHERE))
    facts = [F.sum(c).alias(name) for name, c in sums.items()]
    facts += [F.max(c).alias(name) for name, c in highest.items()]
    histogram = settle(df.groupBy(place.alias("place")).agg(F.count("tenths").alias("timed"), *facts))
    return ordered_scan(histogram, "place", running=["timed"], overall=["timed"]).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
        *[F.max(name).alias(name) for name in highest],
        (median_position("place", "timed") / 10).alias("medianLatency"),
    )
