"""Connected components by hooking each node to its smallest neighbour and contracting the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.session import cut_lineage, discard


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v); the label is the smallest node of the component.

    In each step a node takes the smallest of itself and its neighbours, and that one's choice; the edges are written
    anew between the chosen nodes. Nodes that have a smaller neighbour disappear, so the graph shrinks in every step.
    """
    edges = cut_lineage(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-edges")
    labels = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "cc-parents")
        above = first.select(F.col("u").alias("p"), F.col("p").alias("q"))
        parent = cut_lineage(first.join(above, "p").select("u", F.col("q").alias("p")), "cc-parents")
        discard(first)
        to = lambda name: parent.select(F.col("u").alias(name), F.col("p").alias(f"_{name}"))
        before, labels = labels, labels.join(to("label"), "label", "left").select("node", F.coalesce("_label", "label").alias("label"))
        labels = cut_lineage(labels, "cc-labels")
        discard(before)
        moved = edges.join(to("u"), "u").join(to("v"), "v").where("_u <> _v")
        larger, edges = edges, cut_lineage(moved.select(F.least("_u", "_v").alias("u"), F.greatest("_u", "_v").alias("v")).distinct(), "cc-edges")
        discard(larger, parent)
    return labels
