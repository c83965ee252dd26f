"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Workspace


FEW_EDGES = 50_000  # as many rows fit one task many times over


def _star(edges: DataFrame, large: bool, few: bool) -> DataFrame:
    """Link the neighbours of every node to its smallest neighbour.

    The smallest neighbour is a map-side aggregated minimum joined back, so a node with
    very many neighbours is never gathered in one task. ``few`` edges are handled in one
    task without any shuffle.
    """
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = around.coalesce(1) if few else around
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = around.groupBy("a").agg(F.min("b").alias("m"))
    lowest = lowest.select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    linked = around.join(lowest, F.col("a") == F.col("node"))
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            lowest.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
        out = out.coalesce(1) if few else out
    return out.where("a <> b").groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``node, component`` for the nodes of ``edges(a, b)``; the smallest node names a component.

    Nodes without an edge to another node are absent. The number of rounds grows with
    the logarithm of the longest path; every round is a written table.
    """
    def mark(df: DataFrame) -> tuple:
        seen = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(seen)

    now = work.put(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = mark(now)
    while state[0]:
        few = state[0] <= FEW_EDGES
        step = work.put(_star(_star(now.coalesce(1) if few else now, True, few), False, few))
        new = mark(step)
        work.drop(now)
        now = step
        if new == state:
            break
        state = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
