"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the same, a node of it, all over a component.

    Each round every node points to its least neighbour or itself, pointers are followed once more, and the graph is
    contracted to the nodes pointed to, so rounds grow with the logarithm of the longest path. A node with very many
    links is one row after the partial minimum. Links of a node to itself and repeated links are allowed.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    total = nodes.select("node", F.col("node").alias("root"))
    edges = materialize(links.select(low, high).where("a != b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        step = materialize(least, "pointers")
        on = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        step = materialize(step.join(on, "to").select("node", F.col("further").alias("to")), "pointers")
        a = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        b = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = edges.join(a, "a").join(b, "b").where("ta != tb")
        edges = materialize(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        by_root = step.withColumnRenamed("node", "root")
        total = total.join(by_root, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return materialize(total, "components")
