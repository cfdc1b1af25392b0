"""Connected components by Spark joins: minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (``a, b``) to ``v, root``: the least vertex of each component.

    Each round gives a vertex the least label among its own, its neighbours'
    and its label's label; rounds double the reach along chains.  The driver
    sees one count per round.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = saved(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("v"), F.least("a", "m").alias("root")))
    while True:
        near = (both.join(labels.select(F.col("v").alias("b"), F.col("root").alias("r")), "b")
                .groupBy("a").agg(F.min("r").alias("r")))
        jump = labels.select(F.col("v").alias("root"), F.col("root").alias("j"))
        nxt = (labels.join(jump, "root", "left").join(near.withColumnRenamed("a", "v"), "v")
               .select("v", F.least("root", "r", "j").alias("new"), "root"))
        nxt = saved(nxt)
        moved = nxt.where(F.col("new") < F.col("root")).limit(1).count()
        labels = nxt.select("v", F.col("new").alias("root"))
        if not moved:
            return labels
