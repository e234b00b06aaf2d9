"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node in ``edges`` (a, b); component is the least node reachable.

    Each round links every node to the least of its neighbours: first the
    larger neighbours (large star), then the smaller ones (small star). The
    rounds end when no edge changes; their number grows with the logarithm of
    the nodes. Only minima are aggregated, so a hub is combined map-side;
    each round is a stored table.
    """
    links = common.stored(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = _signature(links)
    while True:
        large = _star(links.union(links.select("b", "a")), larger=True)
        links = common.stored(_star(large, larger=False), "links")
        after = _signature(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _signature(edges: DataFrame) -> tuple:
    """Number of edges and the exact sum of their hashes: equal tables have equal ones."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's larger neighbours, or its smaller ones and itself, to its least neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = edges.join(least, "a")
    if larger:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").distinct()
