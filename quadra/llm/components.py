"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is an aggregation with map-side combine and a lookup of each node's smallest neighbour; nothing is collected,
and each round is cut by a checkpoint. Rounds grow with the logarithm of the longest path. A node with very many
neighbours (the centre of a star) does not gather its edges in one task: see :mod:`quadra.llm.hot`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.llm.hot import lookup
from quadra.session import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("a", "b"), 24))).first())


def _least(edges: DataFrame) -> DataFrame:
    """(a, m, n): the smallest b beside each a, and the number of its edges."""
    return cut(edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))


def connected(edges: DataFrame) -> DataFrame:
    """edges (a, b) of one ordered type -> (node, root): each node with the smallest node of its component. Nodes
    without an edge to another node are left out; nulls and repeated edges do no harm."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut(now)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).withColumn("m", F.least("a", "m"))
        large = lookup(both, least, "a", "n", 2 * state[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large)
        small = lookup(large, _least(large), "a", "n", state[0]).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = cut(small.select("e.a", "e.b").where("a <> b").distinct())
        new = _state(now)
        if new == state:
            break
        state = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
