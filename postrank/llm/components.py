"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every
step is a group-by with map-side combining and a join, so a node with very many
neighbours is never gathered in one place; the join's large side can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postrank.storage import free, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns of one ordered type).

    The root is the smallest node of the component. Loops and repeated edges are
    allowed; nodes without an edge to another do not appear. The result reads a
    stored table; ``free`` it once what is made of it is stored.
    """
    a, b = edges.columns
    now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges"
    )
    mark = _mark(now)
    while mark[0]:
        old, now = now, written(_small_star(_large_star(now)), "edges")
        free(old)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    found = now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
    found.stored_at = now.stored_at
    return found
