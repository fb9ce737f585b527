"""Names that were processed before, kept in buckets so that a view of the backlog never shuffles them.

The table is external: its files lie in a folder of the caller, bucketed by a hash of the name, and any session can declare it again. Each
increment adds files to the buckets. The backlog joins bucket to bucket: the landing names, which are few, are dealt out the way the history
already lies, and the history is read in place.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def open_history(spark: SparkSession, table: str, folder: str, key: str = "fileName", buckets: int = 64) -> DataFrame:
    """The table of processed names, declared over ``folder`` if this catalog does not know it.

    ``buckets`` should be at least the number of shuffle partitions, so that Spark keeps the history's layout, and must stay the
    same for a folder.
    """
    if not _NAME.fullmatch(table):
        raise ValueError(f"not a table name: {table!r}")
    place = folder.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (`{key}` STRING) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)


def remember(table: str, *processed: DataFrame | None, key: str = "fileName") -> None:
    """Add the names of the frames that the history does not know; null names and frames without the column are left out.

    Only the increment is shuffled. Adding one twice, after a crash in between, leaves each name once; two that run at once may
    leave a name twice, which no backlog shows.
    """
    frames = [df.select(key) for df in processed if df is not None and key in df.columns]
    if not frames:
        return
    fresh = frames[0]
    for more in frames[1:]:
        fresh = fresh.unionByName(more)
    spark = fresh.sparkSession
    fresh = _not_in_history(fresh.where(F.col(key).isNotNull()).distinct(), spark.table(table), key)
    buckets = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").head().data_type
    # One file per bucket and increment: the rows of a bucket meet in one task.
    dealt = fresh.repartition(int(buckets), key)
    dealt.write.insertInto(table)
    spark.catalog.refreshTable(table)


def _not_in_history(names: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """A merge join, so that the history is never sent to all tasks however small it looks."""
    return names.join(history.hint("merge"), key, "left_anti")


def backlog_since(landing: DataFrame, table: str, key: str = "fileName") -> DataFrame:
    """Distinct landing names that the history does not hold."""
    spark = landing.sparkSession
    return _not_in_history(landing.select(key).distinct(), spark.table(table), key)
