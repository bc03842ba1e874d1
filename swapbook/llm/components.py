"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swapbook.llm.store import gathered


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b): the smallest node that can be reached.

    Each round takes the least label among the neighbours, then the label of that label, which halves the way to
    the root. Rounds are cut by a checkpoint; the driver sees only the number of labels that changed.
    """
    edge = links.filter("a <> b").select("a", "b")
    both = gathered(edge.unionByName(edge.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = gathered(both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("node"), F.least("a", "_m").alias("component")))
    while True:
        beside = both.join(labels.withColumnsRenamed({"node": "b", "component": "_l"}), "b").groupBy("a").agg(F.min("_l").alias("_m"))
        lower = labels.join(beside.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("_old"), F.least("component", "_m").alias("_new")
        )
        roots = labels.withColumnsRenamed({"node": "_new", "component": "_root"})
        jumped = lower.join(roots, "_new", "left").select(
            "node", "_old", F.least("_new", F.coalesce("_root", "_new")).alias("component")
        )
        jumped = gathered(jumped)
        labels = jumped.select("node", "component")
        if jumped.filter(F.col("component") != F.col("_old")).isEmpty():
            return labels
