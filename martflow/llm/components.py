"""Connected components of a graph given as a table of edges, on tables alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.workspace import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) of all nodes of the edges ``a``, ``b``.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to its smallest one, then
    its smaller neighbours are. Every round is stored, so nothing is computed twice and no lineage grows.
    """
    current = materialise(_oriented(edges), "edges")
    seen = None
    while True:
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _tied(both, F.col("b") > F.col("a"))
        small = _tied(_oriented(large), F.lit(True))
        current = materialise(_oriented(small), "edges")
        # Settled when every tie leads to a node without a smaller one, and the ties stay the same.
        state = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _tied(edges: DataFrame, moved) -> DataFrame:
    """Tie the neighbours ``b`` that are ``moved``, and ``a`` itself, to the smallest of ``a`` and its neighbours."""
    smallest = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    moved_edges = edges.where(moved).join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved_edges.unionByName(smallest.select("a", F.col("least").alias("b")))
