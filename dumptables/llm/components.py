"""Connected components of a graph of links, by alternating large and small stars.

Each round is two groupings that combine within tasks and two joins on node ids; the edges of a
round are written to the shared folder, so neither lineage nor driver memory grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumptables.llm.common import written


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return both.join(_smallest(both), "u").filter("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    joined = edges.join(_smallest(edges), "u")
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(joined.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of ``links`` (two columns of ids, in any direction)
    the smallest id it reaches. Nodes without links do not occur."""
    a, b = links.columns
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = written(edges.distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)).distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
