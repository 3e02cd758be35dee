"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of longs to (id, component): the smallest id reachable, for ids with an edge.

    Alternates two star steps until nothing changes: every node hangs its larger
    neighbours on its smallest one, then its smaller ones. Edges only shrink in
    reach, so rounds grow with the logarithm of a component's size. The smallest
    neighbour is an aggregate that combines before the shuffle; a hub's edges
    meet it by a join, whose skewed partitions Spark may split.
    """
    pairs = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )

    def star(now: DataFrame, large: bool) -> DataFrame:
        both = now.union(now.select(F.col("v"), F.col("u"))) if large else now
        low = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        low = low.withColumn("m", F.least("w", "m"))
        told = both.join(low, both["u"] == low["w"])
        if large:
            kept = told.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            kept = told.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select(F.col("w").alias("u"), F.col("m").alias("v"))
            )
        return kept.filter("u <> v").distinct()

    def digest(now: DataFrame) -> tuple:
        return tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    before = digest(pairs)
    while before[0]:
        half = stored(star(pairs, True))
        after = stored(star(half, False))
        dropped(half)
        dropped(pairs)
        pairs, now = after, digest(after)
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("component"))
    ).distinct()
