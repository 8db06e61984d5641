"""Connected components of a graph given as a table of links, by alternating large and small stars.

No link or component is gathered in one place: each round is two aggregations that take minima (combined before they are moved) and two
joins, and its links are written to the shared folder. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import save


def components(spark: SparkSession, links: DataFrame, a: str, b: str) -> DataFrame:
    """For every node that has a link to another: node, root (the smallest node of its component)."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = save(spark, e, "links")
    before = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if tuple(mark) == before or mark[0] == 0:
            break
        before = tuple(mark)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join's side with the links can be split at a node that very many have a link to
        low = save(spark, both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lows")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = save(spark, small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
