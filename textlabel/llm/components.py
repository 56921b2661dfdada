"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    A star step links every neighbour of a node to the smallest of them. Large stars take the neighbours above a node,
    small stars those below it; a few alternations leave one star for each component. All steps are joins and
    aggregations with map-side minima; nothing is gathered. Each alternation is stored, which cuts the lineage.
    """
    edges = stored(links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo < hi").distinct(), few=True)
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("hi"), F.col("lo"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
                 .filter("lo < hi").distinct())
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        edges = stored(small.select(F.col("m").alias("lo"), "hi").union(small.filter("lo > m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))).distinct(), few=True)
        # settled: the same links as before, by count and the sum of their hashes
        before, state = state, tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return found.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
