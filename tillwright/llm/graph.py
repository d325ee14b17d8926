"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node long, root long (smallest node reachable) of every node in ``edges`` (a long, b long).

    Each round links the larger neighbours of a node to its smallest one (large star), then the smaller ones (small star). Edges
    only ever shrink to stars, and rounds grow with the logarithm of a component's size. Minima are pre-aggregated before
    the shuffle, and edges of a hot node meet its single minimum in a join that adaptive execution can split.
    """
    spark = edges.sparkSession
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # every edge now points from a larger node to a smaller one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(down.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        if same(now, after):
            break
        now = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root")).distinct()


def same(one: DataFrame, other: DataFrame) -> bool:
    """Whether two sets of edges are equal: by size, and by a sum of 64-bit hashes."""
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).alias("mark")
    return one.agg(mark).first() == other.agg(mark).first()
