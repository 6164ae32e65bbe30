"""Connected components of a large edge table: alternating large-star and small-star steps.

Each step takes the smallest neighbour of every node (an aggregate) and joins
it back; no adjacency list is ever built, so a node with very many edges is
only a large join key. Every round's edges are written to the shared folder,
which cuts the lineage. The number of rounds grows with the logarithm of the
longest path; rounds go on until the edges no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import stored


def _stamp(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node that has an edge to another one."""
    e = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col("a") != F.col("b"))
               .distinct(), "edges")
    before = _stamp(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(small.unionByName(least.withColumnRenamed("m", "b")).where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        now = _stamp(e)
        if now == before:
            break
        before = now
    return e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
