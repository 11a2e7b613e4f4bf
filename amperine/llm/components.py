"""Connected components of a table of links, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperine.session import settle

JUMPS = 3


def relabel(rows: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Replaces the column by its parent where it has one."""
    moved = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    return rows.join(moved, F.col(column) == F.col("_node"), "left").withColumn(
        column, F.coalesce("_parent", column)
    ).drop("_node", "_parent")


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node reachable) of every node in links of a and b.

    Each pass hooks every label to its smallest neighbour, follows the new pointers, and
    leaves only links between labels that are still different. State is written after each
    pass, so a lost executor costs one pass at most.
    """
    edges = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    labels = settle(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")))
    while not edges.isEmpty():
        parents = settle(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")))
        for _ in range(JUMPS):
            parents = relabel(parents, parents, "parent")
        parents = settle(parents)
        labels = settle(relabel(labels, parents, "label"))
        moved = relabel(relabel(edges, parents, "a"), parents, "b")
        edges = settle(
            moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
        )
    return labels
