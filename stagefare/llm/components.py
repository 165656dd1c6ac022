"""Connected components of a table of links, by alternating star steps.

Each step rewrites the links so that every vertex points nearer to the smallest vertex
it can reach; links only ever move within a component. A step is one aggregate, which
combines within tasks, and one join, which adaptive execution splits at a hub with very
many links. Steps are tables written to the shared folder, so lost executors cost a
step at most, and only two numbers of a step come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import checksum, discard, materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex links to the least of its neighbours and itself."""
    both = _both_ways(links)
    low = _least(both).select("a", F.least("a", "low").alias("low"))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours link to the least of these."""
    low = _least(links)
    moved = links.join(low, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``(vertex, component)`` for every vertex of ``links(a, b)``; the component is its least vertex.

    Links may repeat, point either way or join a vertex to itself (which adds nothing);
    links with a null end are ignored. No links give no rows.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    edges = materialize(edges.distinct(), "links")
    seen = checksum(edges)
    while seen[0]:
        last, edges = edges, materialize(_small_star(_large_star(edges)).distinct(), "links")
        before, seen = seen, checksum(edges)
        discard(last)
        if before == seen:
            break
    roots = edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(roots)
