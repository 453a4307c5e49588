"""Connected components of a graph that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleskeep.workspace import Workspace


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """(id, component) for every node of the edges (a, b): component is the smallest id reached.

    Alternates two steps until nothing changes. The large star hangs a node's larger neighbours
    on its smallest one, the small star its smaller neighbours. Each takes the minimum per node
    with map-side combining, so a node with very many neighbours is no large group, and every
    round is a written table. The number of rounds grows with the logarithm of the diameter."""
    current, before = workspace.keep(_distinct(edges.filter("a <> b")), "edges"), None
    while (mark := _mark(current)) != before:
        before = mark
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = _distinct(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = workspace.keep(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = workspace.keep(_distinct(moved.union(least)), "small")
    tops = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(tops)


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())
