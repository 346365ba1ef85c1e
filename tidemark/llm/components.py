"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


def _save(scratch: Scratch, edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """Written edges with their count and sum of hashes: equal for equal sets of edges."""
    total = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    edges, seen = scratch.save_seen(edges.select("hi", "lo"), name, total=total)
    return edges, (seen["n"], seen["total"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select("lo", "hi")
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    smaller = edges.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), "m")
    return smaller.union(least).select("hi", F.col("m").alias("lo"))


def components(edges: DataFrame, a: str, b: str, scratch: Scratch, name: str) -> DataFrame:
    """(id, component): each linked node with the least node it can reach.

    Nodes without a link to another node are left out.  Star centres with very
    many neighbours are met by partial aggregates and by joins that adaptive
    execution splits; each round is written, so lineage stays short.  Rounds end
    when the edges are stars, which is after O(log**2 n) rounds, usually three.
    """
    edges = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    edges, mark = _save(scratch, edges.filter("hi > lo").distinct(), f"{name}-0")
    turn = 0
    while mark[0]:
        stars = _small_star(_large_star(edges).filter("hi > lo").distinct())
        turn, before = turn + 1, mark
        edges, mark = _save(scratch, stars.filter("hi > lo").distinct(), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        if mark == before:
            break
    own = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(own)
