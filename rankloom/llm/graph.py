"""Connected components of a link table, without a driver loop over links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom import cluster


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``links(a, b)``; a component is its least node.

    Large-star and small-star steps alternate: each node hands its neighbours to the least
    of them, until every link points at its component. The rounds grow with the logarithm
    of the longest chain. Links may repeat, point at themselves or come either way round.
    """
    edges = cluster.materialise(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        new = cluster.materialise(small.filter("u > v").distinct())
        cluster.drop_materialised(edges)
        edges = new
        now = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == state:
            break
        state = now
    pairs = edges.groupBy("u").agg(F.min("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), "component").unionByName(
        pairs.select(F.col("component").alias("node"), "component").distinct())
