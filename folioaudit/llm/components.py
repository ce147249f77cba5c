"""Connected components by alternating large-star and small-star steps.

Each step is an aggregate and a join over (node, neighbour) rows. No component
is gathered anywhere: a node with very many neighbours is reduced to its
minimum before the shuffle, and the join that follows can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, spread_join


def _star(pairs: DataFrame, keep_larger: bool) -> DataFrame:
    """Point the neighbours of each node ``u`` at the least of them all."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    kept = pairs.filter(F.col("v") > F.col("u")) if keep_larger else pairs
    moved = spread_join(kept, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not keep_larger:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def _mark(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the least node names it.

    Self-links and NULL ends are ignored; no edges give no rows. The number of
    rounds grows with the logarithm of the longest path.
    """
    a, b = F.col("a"), F.col("b")
    pairs = edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
    pairs = checkpointed(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs = checkpointed(_star(_star(both, True), False))
        before, mark = mark, _mark(pairs)
        if mark == before:
            break
    roots = pairs.select(F.col("v").alias("u"), "v").distinct()
    return pairs.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
