"""Order-dependent computations without putting a whole table into one task.

A window with ORDER BY but no PARTITION BY sends every row to a single task.
The helpers below get the same values from windows over short, provably bounded
stretches of the order, plus a window over one summary row per stretch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelight.functions.instants import floor_to
from tidelight.session import settle

# Positions per stretch: no window below ever sees more rows than this.
STRETCH = 65_536
# Beyond this width the LONG range itself leaves few positions.
_MAX_WIDTH = 2**62


def ordered_scan(
    df: DataFrame,
    position: str,
    step: int = 1,
    running: Sequence[str] = (),
    previous: Sequence[str] = (),
    following: Sequence[str] = (),
    overall: Sequence[str] = (),
    levels: int = 1,
) -> DataFrame:
    """Running totals and neighbour values along a LONG column.

    ``df`` has at most one row per ``position``. For each column ``c`` named in the arguments the result gains

    * ``c_run``  sum of ``c`` up to and including the row,
    * ``c_prev`` / ``c_next``  ``c`` of the neighbouring row (``c`` must not be NULL),
    * ``c_all``  sum of ``c`` over the table.

    Stretches of ``STRETCH`` steps are scanned in parallel; ``levels`` says how
    often the stretches are themselves grouped into stretches before the last,
    unpartitioned window. At one level and one-second steps that window holds
    one row per 18 hours of data, at two levels and one-microsecond steps one per 71 minutes.

    ``df`` is used twice. When it has columns besides those named here, the two
    uses read different columns and share no shuffle: settle it first.
    """
    width = step * STRETCH
    if levels == 0 or width > _MAX_WIDTH:
        return _scan_window(df, Window.orderBy(position), running, previous, following, overall)

    stretch = f"_stretch{levels}"
    placed = df.withColumn(stretch, floor_to(F.col(position), width))
    summary = {c: F.sum(c).alias(c) for c in (*running, *overall)}
    edges = [F.max_by(c, position).alias(f"{c}_last") for c in previous]
    edges += [F.min_by(c, position).alias(f"{c}_first") for c in following]
    per_stretch = placed.groupBy(stretch).agg(F.count(F.lit(1)).alias("_rows"), *summary.values(), *edges)
    above = ordered_scan(
        per_stretch,
        stretch,
        width,
        running=running,
        previous=[f"{c}_last" for c in previous],
        following=[f"{c}_first" for c in following],
        overall=overall,
        levels=levels - 1,
    ).select(
        stretch,
        *[(F.col(f"{c}_run") - F.col(c)).alias(f"{c}_before") for c in running],
        *[F.col(f"{c}_last_prev").alias(f"{c}_before_prev") for c in previous],
        *[F.col(f"{c}_first_next").alias(f"{c}_after_next") for c in following],
        *[f"{c}_all" for c in overall],
    )
    within = Window.partitionBy(stretch).orderBy(position)
    local = _scan_window(placed, within, running, previous, following)
    joined = local.join(above, stretch, "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"{c}_run") + F.col(f"{c}_before")).alias(f"{c}_run") for c in running],
        *[F.coalesce(f"{c}_prev", f"{c}_before_prev").alias(f"{c}_prev") for c in previous],
        *[F.coalesce(f"{c}_next", f"{c}_after_next").alias(f"{c}_next") for c in following],
        *[f"{c}_all" for c in overall],
    )


def segmented_previous(df: DataFrame, segment: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add ``<v>_prev``: the value of the row before in the segment's order, NULL for its first row.

    A segment may hold any share of the rows. Rows are range-partitioned by segment and order, numbered by their part, and written
    down; inside a part the neighbours of a stretch are adjacent. What a part's first row of a segment lacks is the last row of
    that segment in an earlier part, found among one summary row per segment and part; at most one segment goes on into a part, so
    what is sent to all tasks has at most a row per part. ``order`` must
    tell the rows of a segment apart, or neighbours of equal rows are arbitrary.
    """
    keys = [segment, *order]
    numbered = df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    pinned = settle(numbered)
    inside = Window.partitionBy("_part", segment).orderBy(*order)
    edges = pinned.groupBy(F.col("_part").alias("_at"), F.col(segment).alias("_segment")).agg(
        F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    )
    earlier = F.lag("_last").over(Window.partitionBy("_segment").orderBy("_at"))
    carried = edges.withColumn("_carried", earlier).where("_carried IS NOT NULL").drop("_last")  # at most one row per part
    local = pinned.withColumns({"_first": F.row_number().over(inside) == 1} | {f"{v}_prev": F.lag(v).over(inside) for v in values})
    same = (F.col("_part") == F.col("_at")) & F.col(segment).eqNullSafe(F.col("_segment")) & F.col("_first")
    joined = local.join(F.broadcast(carried), same, "left")
    before = {f"{v}_prev": F.when(F.col("_first"), F.col(f"_carried.{v}")).otherwise(F.col(f"{v}_prev")) for v in values}
    return joined.select(*df.columns, *(c.alias(name) for name, c in before.items()))


def _scan_window(
    df: DataFrame,
    order,
    running: Sequence[str],
    previous: Sequence[str],
    following: Sequence[str],
    overall: Sequence[str] = (),
) -> DataFrame:
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*",
        *[F.sum(c).over(so_far).alias(f"{c}_run") for c in running],
        *[F.lag(c).over(order).alias(f"{c}_prev") for c in previous],
        *[F.lead(c).over(order).alias(f"{c}_next") for c in following],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in overall],
    )


def holds_rank(rank: Column, count: str) -> Column:
    """Whether the 0-based ``rank`` falls on a histogram row scanned with ``running=[count]``."""
    return (rank < F.col(f"{count}_run")) & (rank >= F.col(f"{count}_run") - F.col(count))


def median_position(position: str, count: str) -> Column:
    """Median of a scanned histogram, as an aggregate; midpoint of the two middle values."""
    total = F.col(f"{count}_all")
    lower = F.floor((total - 1) / 2)
    upper = F.floor(total / 2)
    middle = [F.max(F.when(holds_rank(rank, count), F.col(position))) for rank in (lower, upper)]
    return (middle[0] + middle[1]) / F.lit(2.0)


def with_row_index(df: DataFrame, *order: Column | str, name: str = "rowIndex") -> DataFrame:
    """Add the exact 0-based position of each row in the given order.

    Rows are range-partitioned, numbered inside their partition and written to
    the shared folder, so that the partition sizes and the numbers come from one
    and the same partitioning. The offset table has one row per partition.
    ``order`` should identify rows, or equal keys are numbered arbitrarily.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    pinned = settle(
        sorted_parts.withColumns({"_part": F.spark_partition_id(), "_inside": inside})
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pinned.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = pinned.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_inside")).alias(name))


def salted_lookup(
    df: DataFrame, table: DataFrame, key: str, spread_by: str, salts: int = 16
) -> DataFrame:
    """Inner join to a table with one row per ``key``, safe when one key holds most rows of ``df``.

    Each lookup row is repeated ``salts`` times and the rows of ``df`` choose
    among the copies by a hash of ``spread_by``.
    """
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    return salted.join(copies, [key, "_salt"]).drop("_salt")
