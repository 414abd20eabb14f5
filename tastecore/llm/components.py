"""Connected components by repeated hooking and shortcuts, all as joins on staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastecore.plans.staging import stage


def _mapped(edges: DataFrame, moves: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes that `moves` (node, up) sends their ends to; loops and doubles go."""
    for end in ("a", "b"):
        m = moves.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
        edges = edges.join(m, F.col(end) == F.col("_node"), "left").withColumn(end, F.coalesce("_up", end)).drop("_node", "_up")
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _flat(moves: DataFrame) -> DataFrame:
    """Follow the moves, which always go to smaller nodes, to their ends."""
    while True:
        ahead = moves.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
        moves = stage(moves.join(ahead, F.col("up") == F.col("_node"), "left").select("node", F.coalesce("_up", "up").alias("up"), (F.col("_up") < F.col("up")).alias("_moved")), "moves")
        done = not moves.filter("_moved").head(1)
        moves = moves.select("node", "up")
        if done:
            return moves


def connect(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after joining, by links (a, b) between nodes, the sets that `roots` (node, root) states.

    A root is the smallest node of its set; nodes of `links` have to be in `roots`.
    """
    edges = stage(_mapped(links, roots.select("node", F.col("root").alias("up"))), "edges")
    while edges.head(1):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = _flat(both.groupBy("a").agg(F.min("b").alias("b")).filter("b < a").select(F.col("a").alias("node"), F.col("b").alias("up")))
        m = moves.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
        roots = stage(roots.join(m, F.col("root") == F.col("_node"), "left").select("node", F.coalesce("_up", "root").alias("root")), "roots")
        edges = stage(_mapped(edges, moves), "edges")
    return roots
