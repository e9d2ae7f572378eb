"""Connected components of a link table by rounds of joins; no component meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.session import shared_folder


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; root is the least node reachable.

    Alternates two steps until nothing moves: each node's larger neighbours are linked to its
    least neighbour, then each node and its smaller neighbours are. Each step is an aggregate
    with map-side combine and a join on the node, so a node with very many links is folded or
    split; every round ends in a checkpoint, which cuts the lineage and survives executors.
    """
    shared_folder(links.sparkSession)
    edges = _directed(links.select("a", "b")).distinct().checkpoint()
    before = None
    while True:
        edges = _to_least(edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))), larger=True)
        edges = _to_least(edges, larger=False).checkpoint()
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("low").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).union(roots)


def _directed(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))


def _to_least(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges of each ``high`` node re-hung on the least of itself and its neighbours ``low``."""
    least = edges.groupBy("high").agg(F.min("low").alias("other")).select("high", F.least("high", "other").alias("least"))
    hung = edges.join(least, "high")
    if larger:
        moved = hung.where("low > high").select(F.col("low").alias("a"), F.col("least").alias("b"))
        return _directed(moved).distinct()
    moved = hung.select(F.col("low").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("high").alias("a"), F.col("least").alias("b"))
    return _directed(moved.union(own)).distinct()
