"""Connected components of links, by joins and checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dewpoint.llm.common import kept


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex, component`` for every vertex of ``links``; the component is its least vertex.

    Alternates large and small stars until nothing changes: every vertex hands its least
    neighbour to its larger ones, then to its smaller ones, so that each component ends as
    a star around its least vertex. Links of a vertex of any degree are joined and
    aggregated by partial minima, never gathered; each round is checkpointed.
    """
    edges = kept(
        links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _digest(edges)
    while True:
        edges = kept(_small_star(_large_star(edges)))
        before, state = state, _digest(edges)
        if state == before:
            break
    starred = edges
    centres = starred.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return starred.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(centres)


def _digest(edges: DataFrame) -> tuple:
    """Two numbers that differ when the edges do; one row, whatever their number."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the vertex's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, is linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u")
        .filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
