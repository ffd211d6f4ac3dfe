"""Connected components of a link table by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import settle


def smallest_reachable(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, label``: for every node of ``links`` (``a, b``) the smallest node it is connected with.

    Every round takes the smallest label among the neighbours and then follows labels one step,
    so long chains shrink by halves. A round is a stored table in the shared folder: a lost
    executor costs its own tasks, and plans stay short. Hubs are plain join keys with partial
    aggregation, which adaptive execution splits; only a count reaches the driver.
    """
    both = settle(
        links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            links.select(F.col("b"), F.col("a"))
        ),
        "links",
    )
    labels = settle(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        offered = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("offered"))
        )
        lower = settle(
            labels.join(offered, "node").select(
                "node", F.col("label").alias("before"), F.least("label", "offered").alias("label")
            ),
            "offers",
        )
        heads = lower.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        jumped = settle(
            lower.join(heads, "label").select("node", "before", F.least("label", "ahead").alias("label")),
            "labels",
        )
        labels = jumped.select("node", "label")
        if jumped.where(F.col("label") != F.col("before")).limit(1).count() == 0:
            return labels
