"""Connected components of links, by rounds of stored label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termflow.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for nodes with links.

    ``edges`` has long columns a and b, in one direction or both. In each round
    a node takes the least of itself and its neighbours, and then what that one
    took, so chains shorten by half and stars end at once. Edges then join what
    their ends took; those within one label go, so a later round has few. What a
    node took is beside it along edges, so no label loses touch with its own node.
    Neighbours are combined before the shuffle, and joins on hub nodes can be split.
    """
    edges = _stored_edges(edges.select("a", "b"))
    labels, rounds = None, 0
    while True:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = sides.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        nearest = nearest.select("node", F.least("node", "least").alias("component"))
        nearest = stored(nearest, "labels")
        taken = stored(_relabelled(nearest, "component", nearest), "labels")
        labels = _relabelled(labels, "component", taken, "left") if rounds else taken
        rounds += 1
        edges = _stored_edges(_relabelled(_relabelled(edges, "a", taken), "b", taken))
        if edges.isEmpty():
            return stored(labels, "labels") if rounds > 1 else labels


def _stored_edges(edges: DataFrame) -> DataFrame:
    """Each edge once, from its smaller end, without loops."""
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return stored(edges.where("a != b").select(*ends).distinct(), "edges")


def _relabelled(
    rows: DataFrame, name: str, labels: DataFrame, how: str = "inner"
) -> DataFrame:
    """The rows with the label of the node in column ``name`` in its place."""
    targets = labels.select(
        F.col("node").alias("labelled"), F.col("component").alias("target")
    )
    return rows.join(targets, F.col(name) == F.col("labelled"), how).select(
        *(
            F.coalesce("target", name).alias(name) if column == name else column
            for column in rows.columns
        )
    )
