"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelight.session import settle


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``class_id`` (the smallest node of its component) of every node in ``links`` (long ``a``, long ``b``).

    Every node takes the smallest label among its neighbours, and then that label's own label, until nothing changes: the
    second step halves the remaining distance, so long chains take few rounds. Each round is written to the shared folder.
    Repeated links and links to itself do no harm. A node with very many links is reduced to one row per
    task before it is shuffled.
    """
    both = settle(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("class_id")))
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("class_id").alias("near"))
        around = both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(around, "node").select("node", "class_id", F.least("class_id", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("class_id").alias("further"))
        following = settle(
            lower.join(jump, "next").select(
                "node", F.least("next", "further").alias("class_id"), (F.col("next") < F.col("class_id")).alias("moved"),
                (F.col("further") < F.col("next")).alias("jumped"),
            )
        )
        labels = following.select("node", "class_id")
        if not following.where("moved OR jumped").limit(1).count():
            return labels
