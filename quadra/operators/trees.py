"""Quadtrees of tiles: splitting, statistics and consistency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.tables import children

KEY = ["zoom", "x", "y"]


def split_leaves(tree: DataFrame, sizes: DataFrame, limit: int, max_zoom: int = 14) -> DataFrame:
    """Leaves larger than ``limit`` and above ``max_zoom`` become inner tiles with four leaves (A16). ``sizes``: (zoom, x, y,
    size); a tile without a size is small."""
    t = tree.join(sizes, KEY, "left").withColumn("cut", F.col("final") & (F.coalesce("size", F.lit(0)) > limit) & (F.col("zoom") < max_zoom))
    kept = t.select(*KEY, (F.col("final") & ~F.col("cut")).alias("final"), F.lit(False).alias("new"))
    new = t.where("cut").select((F.col("zoom") + 1).alias("zoom"), F.explode(children("x", "y")).alias("c")).select("zoom", "c.x", "c.y", F.lit(True).alias("final"), F.lit(True).alias("new"))
    return kept.unionByName(new)


def subtree_statistics(tree: DataFrame, level: int) -> DataFrame:
    """Per tile of a level: number, smallest and largest zoom of the leaves below it."""
    leaves = tree.where(F.col("final") & (F.col("zoom") >= level))
    up = lambda c: F.expr(f"shiftright({c}, zoom - {level})").alias(c)
    return leaves.select("zoom", up("x"), up("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("leaves"), F.min("zoom").alias("min_zoom"), F.max("zoom").alias("max_zoom"))


def subtrees(tree: DataFrame, level: int) -> DataFrame:
    """The tiles of a level, and whether each is a leaf."""
    return tree.where(F.col("zoom") == level)


def leaves(tree: DataFrame) -> DataFrame:
    return tree.where("final").drop("final")


def inconsistencies(tree: DataFrame) -> DataFrame:
    """Tiles that break the tree (A15): an inner tile without one of its children, a child whose parent is not inner."""
    inner = tree.where("not final").select(*KEY)
    kids = inner.select((F.col("zoom") + 1).alias("zoom"), F.explode(children("x", "y")).alias("c")).select("zoom", "c.x", "c.y")
    missing = kids.join(tree.select(*KEY), KEY, "left_anti").withColumn("problem", F.lit("missing"))
    orphan = tree.where("zoom > 0").select(*KEY).join(kids, KEY, "left_anti").withColumn("problem", F.lit("orphan"))
    return missing.unionByName(orphan)
