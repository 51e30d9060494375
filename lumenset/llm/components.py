"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, release


def components(links: DataFrame) -> DataFrame:
    """node and root, the least node that it is connected with, for all nodes of links (a, b).

    Links may repeat or join a node to itself (such a node is its own root). Least neighbours come from an aggregate
    that combines before its shuffle and a join that Spark may split where a node has very many links. The number of
    rounds grows with the logarithm of the longest chain. It ends when a round leaves the number of links and the sum of
    their 64-bit hashes as they were.
    """
    selves = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    edges = checkpoint(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # few links need few tasks and files, however many partitions the session has
        sizes = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == sizes or not sizes[0]:
            break
        before, few = sizes, max(4, sizes[0] // 100_000)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = checkpoint(large.coalesce(few))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpoint(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct().coalesce(few))
        del both, large, least, small
        release(links.sparkSession)  # else the shuffles of all rounds lie on the disks at the end
    return selves.join(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
