"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the smallest node that it reaches.

    A round takes the smallest label among the neighbours, then the label of the label; the number of
    rounds follows the logarithm of a component's width where links are stars. Every round is a
    written table. A node with very many links costs one row per input partition (partial minimum) and
    a join that adaptive execution can split.
    """
    both = written(links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("least"))
        joined = labels.join(near, labels["node"] == near["a"]).select("node", "component", F.least("component", "least").alias("lower"))
        jump = labels.select(F.col("node").alias("lower"), F.col("component").alias("further"))
        lower = written(
            joined.join(jump, "lower").select("node", F.least("lower", "further").alias("component"), (F.col("component") != F.least("lower", "further")).alias("changed")),
            "labels",
        )
        changed = not lower.where("changed").isEmpty()
        discard(labels)
        labels = lower.select("node", "component")
        if not changed:
            discard(both)
            return labels
