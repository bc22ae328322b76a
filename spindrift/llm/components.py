"""Connected components by alternating large-star and small-star steps, entirely in DataFrames.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each step takes a minimum per
node (combined before its shuffle) and one join; nothing about the graph reaches the driver but a
row count and a checksum. A hub's edges are not dealt to one task: up to `SMALL` edges (counted) the
minima are broadcast to where the edges lie; beyond that adaptive execution splits the join's large keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard


#: Edges up to which the minima of their nodes are broadcast.
SMALL = 500_000


def _large_star(e: DataFrame, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(hint(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(hint(least), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _sum(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root) for every node of `edges` (any orderable type); root is the least node it reaches.

    Null ends and self-loops add no link; nodes without a link to another node get no row.
    """
    e = cut(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v").distinct())
    seen = _sum(e)
    while seen[0]:
        hint = F.broadcast if seen[0] <= SMALL else lambda d: d
        nxt = cut(_small_star(_large_star(e, hint), hint).distinct())
        now = _sum(nxt)
        discard(e)
        e = nxt
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
