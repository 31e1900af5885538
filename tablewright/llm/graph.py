"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import pin


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node that a link names: the least node of its component.

    Each round a node takes the least label among its neighbours, then the label of its
    label, so labels jump along chains and the rounds grow with the logarithm of a
    component's width. Hubs cost no more than their links: minima are combined before
    the shuffle and the joins carry one narrow row a link. Labels are pinned each round.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = pin(both.filter("u <> v").distinct())
    labels = pin(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        seen = labels.select(F.col("node").alias("v"), F.col("label").alias("seen"))
        near = edges.join(seen, "v").groupBy(F.col("u").alias("node")).agg(F.min("seen").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = pin(
            hooked.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label"))
        )
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
