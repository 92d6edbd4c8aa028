"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import materialize

MAX_ROUNDS = 100


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _point_to_least(around: DataFrame) -> DataFrame:
    """(a, least): the smaller of each node and its smallest neighbour."""
    return around.groupBy("a").agg(F.min("b").alias("least")) \
                 .select("a", F.least("a", "least").alias("least"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of ``edges`` (long columns ``a``, ``b``)
    the smallest node that it reaches.

    Alternating large-star and small-star steps: every neighbour of a node is
    linked to the smallest node around it, first the larger neighbours, then
    the smaller ones and itself, until only stars are left.  Both steps are a
    pre-aggregated minimum and a join, so a hub's neighbours never meet in
    one group; each round is written to the shared folder.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                             .distinct(), "component-edges")
    before = None
    for _ in range(MAX_ROUNDS):
        around = _both_ways(edges)
        large = (around.join(_point_to_least(around), "a").where("b > a")
                       .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        # Now a > b in every row: link a node's smaller neighbours, and the node, to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
                      .union(least.select("a", F.col("least").alias("b"))).distinct())
        edges = materialize(small, "component-edges")
        # Sums over 64-bit nodes as decimals cannot overflow.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
                .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
