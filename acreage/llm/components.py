"""Connected components of links that stay on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.sources.writers import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node in ``links(a, b)``: the same root for what links connect.

    Each round every node points at the neighbour of the smallest rank, itself included, where
    ranks are drawn anew by a hash; links move to what their ends point at and are made distinct.
    So a star of any size is one round, and a chain loses a constant share of its links in each.
    Minima are taken before the shuffle; joins read stored tables, so that adaptive execution may
    split a node with very many links. Links of a node with itself say nothing.
    """
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    labels = None
    level = 0
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def ranked(node: str):
            return F.struct(F.xxhash64(F.lit(level), node).alias("rank"), F.col(node).alias("node"))

        least = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("least"))
        points = stored(least.select("node", F.least(ranked("node"), F.col("least"))["node"].alias("to")))
        if labels is None:
            labels = points.select("node", F.col("to").alias("root"))
        else:
            moved = points.select(F.col("node").alias("root"), "to")
            labels = labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = stored(labels)
        for end in ("a", "b"):
            links = links.join(points.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("to", end)
        links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        level += 1
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
