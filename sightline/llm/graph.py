"""Connected components of links that stay on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.tables import stored


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node of its component.

    Each round takes the least root among the neighbours and then the root's own root, so the rounds
    grow with the logarithm of the longest path for paths and are two or three for stars. Nodes without
    a link are not returned; null ends are ignored; repeated links and loops change nothing.
    """
    links = links.filter("a is not null and b is not null")
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), label)
    # The first round is known without a join: the least of a node and its neighbours.
    roots = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), label
    )
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low"))
        lower = roots.join(near, "node").select("node", "root", F.least("root", "low").alias("low"))
        jump = roots.select(F.col("node").alias("low"), F.col("root").alias("far"))
        step = stored(
            lower.join(jump, "low").select("node", F.least("low", "far").alias("root"), (F.least("low", "far") != F.col("root")).alias("moved")), label
        )
        roots = step.select("node", "root")
        if step.filter("moved").isEmpty():
            return roots
