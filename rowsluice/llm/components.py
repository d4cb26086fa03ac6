"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c


def components(links: DataFrame) -> DataFrame:
    """id, root: the smallest id that each end of a link (columns a, b) can reach.

    Each round joins every node to the smallest id among its neighbours and itself: first its larger
    neighbours, then its smaller ones. Rounds grow with the logarithm of a component's size, every
    round is stored in the shared folder, and hot nodes are pre-aggregated to their minimum.
    """
    edges = c.stored(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u <> v").distinct(), "edges"
    )
    content = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = content(edges)
    while before[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v"), F.col("m").alias("u"))
        # each node with its smaller neighbours
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(
            low.select("v", F.col("m").alias("u"))
        )
        edges = c.stored(small.filter("u <> v").distinct(), "stars")
        now = content(edges)
        if tuple(now) == tuple(before):
            break
        before = now
    return edges.select(F.col("v").alias("id"), F.col("u").alias("root"))
