"""Connected components of a distributed graph, by alternating large and small stars.

Where the edges are few, a round is one job: each node's smallest neighbour is broadcast, so edges
are rewritten where they are read. Beyond that the stars are joined by shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.work import Workspace

#: Edges up to this number are rewritten by broadcasts: two of at most a row per edge.
BROADCAST_EDGES = 250_000
#: Steps from a node towards its smallest neighbour's smallest neighbour in one such round.
JUMPS = 4


def _stars(edges: DataFrame, space: Workspace | None) -> DataFrame:
    """One star step over (u, v) with u > v: the large star, where a space is given, or the small.

    Each node's smallest neighbour is an aggregate, joined back to the edges, so a node with very
    many neighbours is a skewed join key and never one group in memory. In the large star, where
    centres have most edges, the aggregate is written first: then both sides of the join are
    plain exchanges, and adaptive execution splits such a key.
    """
    if space is not None:  # repeated edges go with the small star
        sides = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = space.table(sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")),
                            "least")
        return sides.join(least, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").filter("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
        least.select("u", F.col("m").alias("v"))).distinct()


def _short_round(edges: DataFrame) -> DataFrame:
    """Both stars over a few (u, v) with u > v, and whether an edge ``changed``; one row per edge.

    An edge follows its smaller end ``JUMPS`` times to that end's smallest neighbour. All nodes on
    such a way keep an edge to a smaller one of the same way, so what was connected stays so.
    """
    edges = edges.select("u", "v")
    least = F.broadcast(edges.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("to")))
    far = edges.withColumn("w", F.col("v"))
    for _ in range(JUMPS):
        far = far.join(least, F.col("w") == F.col("at"), "left").select(
            "u", "v", F.coalesce("to", "w").alias("w"))
    nearest = F.broadcast(far.groupBy(F.col("u").alias("at")).agg(F.min("w").alias("m")))
    return far.join(nearest, F.col("u") == F.col("at")).select(
        F.when(F.col("w") == F.col("m"), F.col("u")).otherwise(F.col("w")).alias("u"),
        F.col("m").alias("v"), (F.col("v") != F.col("m")).alias("changed"))


def _short_stars(now: DataFrame, space: Workspace) -> DataFrame:
    """The stars of a few edges, with repeated rows."""
    while True:
        now = space.table(_short_round(now), "stars")
        if now.filter("changed").isEmpty():
            return now


def _long_stars(edges: DataFrame, space: Workspace) -> DataFrame:
    """The stars of edges of any number."""
    now = space.table(edges.distinct(), "distinct_edges")

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(now)
    while True:
        now = space.table(_stars(_stars(now, space), None), "stars")
        after = mark(now)
        if after == seen:
            return now
        seen = after


def components(edges: DataFrame, space: Workspace) -> DataFrame:
    """(node, component) for every node of the (a, b) edges; the component is its smallest node."""
    now = space.table(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    stars = _short_stars if now.count() <= BROADCAST_EDGES else _long_stars
    now = stars(now, space)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
