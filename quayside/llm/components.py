"""Connected components by alternating stars, on tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import freed, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    tied = edges.join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("low").alias("v")).union(least.select("u", F.col("low").alias("v")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(u, root)`` for every node that an edge ``(u, v)`` names; the root is the least of its component.

    Edges may repeat, run either way and form loops. Every round is written
    out, so a lost executor costs one round at most; the number of rounds grows
    with the logarithm of the nodes. Only two sums come to the driver.
    """
    turned = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    held: list[str] = []
    turned = staged(spark, turned, "edges", held)
    before = None
    while True:
        sums = turned.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if before == (sums["n"], sums["x"]):
            break
        before = (sums["n"], sums["x"])
        done, held = held, []
        large = staged(spark, _large_star(turned).where("u <> v").distinct(), "large-star", done)
        turned = staged(spark, _small_star(large).where("u <> v").distinct(), "small-star", held)
        freed(spark, done)
    roots = turned.select("u", F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("u"), "root").distinct())
