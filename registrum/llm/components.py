"""Connected components of links between 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.session import write_and_reread


def components(links: DataFrame, one: str = "a", other: str = "b") -> DataFrame:
    """Columns node and label: the smallest node of its component, for every linked node.

    Each round hooks every node to its smallest neighbour where that is smaller, follows the hooks
    to their ends and shrinks the links to those between different ends. Who is left after two
    rounds has taken in a neighbour of its own, so two rounds at least halve the nodes that still
    have links, whatever the shape: rounds grow with the logarithm of the nodes, and so do the
    steps along the hooks. Every step is written to the shared folder, so a lost executor costs one
    step at most. No links give an empty table.
    """
    near = links.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))
    near = write_and_reread(near.distinct(), "links")
    labels = None
    while True:
        ends = hooked(near)
        if labels is None:
            labels = ends
        else:
            to = ends.select(F.col("node").alias("label"), F.col("label").alias("to"))
            joined = labels.join(to, "label", "left")
            labels = write_and_reread(joined.select("node", F.coalesce("to", "label").alias("label")), "labels")
        for end in ("a", "b"):
            to = ends.select(F.col("node").alias(end), F.col("label").alias("to"))
            near = near.join(to, end).drop(end).withColumnRenamed("to", end)
        near = near.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        near = write_and_reread(near.distinct(), "links")
        if near.isEmpty():
            return labels


def hooked(near: DataFrame) -> DataFrame:
    """node and label of every node of ``near``: where the way along smallest neighbours ends."""
    both = near.select(F.col("a").alias("node"), F.col("b").alias("near"))
    both = both.unionByName(near.select(F.col("b").alias("node"), F.col("a").alias("near")))
    least = both.groupBy("node").agg(F.min("near").alias("near"))
    steps = write_and_reread(least.select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        heads = steps.select(F.col("node").alias("label"), F.col("label").alias("head"))
        moved = steps.join(heads, "label").select("node", F.col("head").alias("label"), F.expr("head <> label AS moved"))
        moved = write_and_reread(moved, "labels")
        done = moved.where("moved").isEmpty()
        steps = moved.select("node", "label")
        if done:
            return steps
