"""Connected components of an edge list, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.session import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for edges ``a, b`` (whole numbers): the smallest node reachable from each node that has an edge.

    Every round takes the smallest label among the neighbours and then the label's own label, so the
    number of rounds grows with the logarithm of the longest path. Minima are combined before the shuffle,
    and each round's labels are written, so nothing is recomputed if an executor is lost.
    """
    both = settle(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("to")).agg(F.min("label").alias("near"))
        low = labels.join(near, labels["node"] == near["to"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        root = labels.select(F.col("node").alias("root"), F.col("label").alias("root_label"))
        new = settle(low.join(root, low["low"] == root["root"], "left").select("node", "old", F.least("low", F.coalesce("root_label", "low")).alias("label")), "labels")
        if not new.where("old <> label").head(1):
            return new.select("node", "label")
        labels = new.select("node", "label")
