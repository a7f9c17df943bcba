"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges(a, b)`` that has a neighbour; ``root`` names its component.

    Each round points every node at its smallest neighbour (or itself) and contracts the edges
    to those; the nodes left shrink by a factor each round. Only joins and sums with map-side
    combining are used, so a hub is neither gathered in one place nor sent to the driver.
    Empty input: empty result. Null nodes and loops are ignored.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        nearest = materialize(nearest, "nearest")
        if labels is None:
            labels = nearest.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            step = nearest.select(F.col("a").alias("root"), "p")
            labels = labels.join(step, "root", "left").select("node", F.coalesce("p", "root").alias("root"))
        labels = materialize(labels, "labels")
        left = nearest.select("a", F.col("p").alias("pa"))
        right = nearest.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        edges = materialize(
            edges.join(left, "a").join(right, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            "edges",
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
