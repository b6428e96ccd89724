"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.store import staged


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of `links` (a long, b long): the label is the smallest node it is connected with.

    Each round every node points at its smallest neighbour, if that is smaller than itself; pointers are followed to their
    ends, and the links between ends are what is left for the next round, far fewer each time. Every step is written, and
    the next starts from there. Links from a node to itself and repeated links do no harm.
    """
    ends = links.select("a", "b")
    labels = staged(ends.select(F.col("a").alias("node")).union(ends.select(F.col("b").alias("node"))).distinct())
    labels = labels.withColumn("label", F.col("node"))
    left = staged(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while left.head(1):
        root = _followed(left)
        labels = staged(
            labels.join(root.toDF("label", "root"), "label", "left").select("node", F.coalesce("root", "label").alias("label"))
        )
        between = left.join(root.toDF("a", "root_a"), "a").join(root.toDF("b", "root_b"), "b").where("root_a <> root_b")
        left = staged(between.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct())
    return labels


def _followed(links: DataFrame) -> DataFrame:
    """node, root: where the way over smallest neighbours ends. Each step doubles the length of the ways followed."""
    both = links.union(links.select("b", "a"))
    at = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")))
    while True:
        onward = at.toDF("root", "further")
        at = staged(at.join(onward, "root").select("node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")))
        if not at.where("moved").head(1):
            return at.select("node", "root")
        at = at.select("node", "root")
