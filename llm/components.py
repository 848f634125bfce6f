"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the least node of its component.

    Every round, a node takes the least label among its neighbours' and then its label's label, so labels travel
    twice as far from round to round. One row per node and per link and direction; a node with many links is joined
    by key, where a skewed join is split, and its labels are reduced in every task before the shuffle. Runs jobs.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = cut_lineage(both)
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least")).select("node", F.least("node", "_least").alias("root")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_near"))
        moved = cut_lineage(labels.join(near, "node").select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("_new")))
        if not moved.where("_new <> _old").limit(1).count():
            return labels
        jump = moved.select(F.col("node").alias("_at"), F.col("_new").alias("_jump"))
        labels = cut_lineage(moved.join(jump, F.col("_new") == F.col("_at")).select("node", F.least("_new", "_jump").alias("root")))
