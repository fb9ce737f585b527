"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points of a 64-bit ring; a key belongs to the arc of the next point clockwise. Keys
that find their shard full go on clockwise, arc by arc, until a shard has room. With ``slack`` 0 the capacities add up
to the number of rows, so counts differ by one at most; a positive slack leaves room, moves fewer keys when the number
of shards changes, and lets counts differ by that share.

Who overflows is settled from the row counts of the arcs alone, a table whose size depends on the parameters only: it
becomes at most one segment per arc plus one per shard. Rows are ranked inside small slices of an arc and look their
segment up, so no task sees a whole shard, and the texts are not shuffled.

* Size: bytes of the text in UTF-8 plus 8 (a null text has none). Groups of equal texts need no care: the key is the id.
* A null ``doc_id`` is placed by its text. Repeated rows take neighbouring slots. An empty table gives no rows.
* Other columns are not read, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CELL_BITS = 12
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1


def ring(spark: SparkSession, shards: int, virtual_nodes: int) -> DataFrame:
    """Arcs of the ring: ``arc`` (clockwise), ``owner``, and their inclusive ends ``low`` and ``high``."""
    points = spark.range(shards * virtual_nodes, numPartitions=1).select(
        F.pmod("id", F.lit(shards)).cast("int").alias("owner"),
        F.xxhash64(F.pmod("id", F.lit(shards)), F.floor(F.col("id") / shards)).alias("high"),
    )
    clockwise = Window.orderBy("high", "owner")
    arcs = points.select(
        (F.row_number().over(clockwise) - 1).alias("arc"), "owner", "high",
        F.coalesce(F.lag("high").over(clockwise) + 1, F.lit(_LOWEST)).alias("low"),
    )
    # What lies behind the last point belongs to the first.
    beyond = points.agg(F.max("high").alias("last"), F.min_by("owner", F.struct("high", "owner")).alias("owner")).select(
        F.lit(0).alias("arc"), "owner", F.lit(_HIGHEST).alias("high"), (F.col("last") + 1).alias("low")
    )
    return arcs.unionByName(beyond).where("low <= high")


def _cell(position: Column) -> Column:
    return F.shiftright(position, 64 - _CELL_BITS)


def settle_loads(arcs: list[tuple[int, int, int]], capacity: list[int]) -> list[dict]:
    """Segments of the arcs' ranks by shard, from (arc, owner, rows) in clockwise order.

    In the n-th round every arc offers what is left of it to the owner of the n-th point clockwise.
    """
    left, room = [rows for _, _, rows in arcs], list(capacity)
    used, slots = [0] * len(arcs), [0] * len(capacity)
    segments = []
    for step in range(len(arcs)):
        waiting = [at for at, rows in enumerate(left) if rows]
        if not waiting:
            break
        for at in waiting:
            shard = arcs[(at + step) % len(arcs)][1]
            taken = min(left[at], room[shard])
            if taken:
                segments.append(
                    {"arc": arcs[at][0], "first": used[at], "last": used[at] + taken - 1, "shard": shard,
                     "base": slots[shard], "home": arcs[at][1]}
                )
                used[at] += taken
                left[at] -= taken
                room[shard] -= taken
                slots[shard] += taken
    return segments


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [-int(-(1 + slack) * rows // shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def shard_by_ring(
    docs: DataFrame, shards: int, virtual_nodes: int = 64, slack: float = 0.0, rows_per_slice: int = 20_000
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` (gapless from 0), ``home_shard`` (before overflowing)."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    position = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(0), text)).otherwise(F.xxhash64("doc_id"))
    arcs = ring(spark, shards, virtual_nodes)
    cells = arcs.select("arc", "low", "high", F.explode(F.sequence(_cell(F.col("low")), _cell(F.col("high")))).alias("cell"))
    total = docs.count()
    slices = max(1, -(-total // (shards * virtual_nodes * rows_per_slice)))
    placed = (
        docs.select(
            "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), position.alias("position"),
        )
        .withColumn("cell", _cell(F.col("position")))
        .join(F.broadcast(cells), "cell")  # at most 2^12 + the number of points
        .where("position BETWEEN low AND high")
        .select("doc_id", "size", "text_crc32", "position", "arc", F.pmod("position", F.lit(slices)).alias("slice"))
    )
    counts = placed.groupBy("arc", "slice").agg(F.count("*").alias("rows"))
    by_arc = {row.arc: row.rows for row in counts.groupBy("arc").agg(F.sum("rows").alias("rows")).collect()}
    owners = {row.arc: row.owner for row in arcs.collect()}  # as many as there are points
    segments = settle_loads(
        [(arc, owner, by_arc.get(arc, 0)) for arc, owner in sorted(owners.items())], capacities(total, shards, slack)
    )
    shape = "array<struct<arc:int,first:bigint,last:bigint,shard:int,base:bigint,home:int>>"
    plan = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(segments)), shape)))
    before = Window.partitionBy("arc").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("arc", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("arc", "slice").orderBy("position", "doc_id", "text_crc32", "size")
    ranked = placed.withColumn("nth", F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, ["arc", "slice"])
        .withColumn("rank", F.col("start") + F.col("nth"))
        .join(F.broadcast(plan), "arc")  # at most one segment per point plus one per shard
        .where("rank BETWEEN first AND last")
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"),
            F.col("home").alias("home_shard"),
        )
    )
