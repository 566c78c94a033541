"""Raw elements of an area, with what they need to be whole (S6): several inputs, their newest versions, completion of ways and
relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.functions.geometry import BOX
from quadra.operators.cover import build_cover, locate_in
from quadra.session import cut


def newest(inputs: list[DataFrame], key: str) -> DataFrame:
    """The rows of each key's highest version among inputs that may overlap; equal rows of several inputs count once."""
    rows = reduce(DataFrame.unionByName, inputs)
    top = rows.groupBy(key).agg(F.max("version").alias("version"))
    return rows.join(top, [key, "version"], "left_semi").dropDuplicates()


def nodes_inside(nodes: DataFrame, box: dict[str, int] | None = None, areas: DataFrame | None = None) -> DataFrame:
    """(node_id) of nodes in a closed box, and inside of areas (``country``, ``outer``, ``holes``), if given."""
    out = nodes
    if box is not None:
        out = out.where(F.col("lon_e7").between(box[BOX[0]], box[BOX[2]]) & F.col("lat_e7").between(box[BOX[1]], box[BOX[3]]))
    if areas is not None:
        out = locate_in(out, build_cover(areas))
    return out.select("node_id").distinct()


def complete(nodes: list[DataFrame], ways: list[DataFrame], members: list[DataFrame], box: dict[str, int] | None = None, areas: DataFrame | None = None) -> dict[str, DataFrame]:
    """What an area's raw build needs of the inputs' newest versions: ``nodes``, ``ways`` and ``members``.

    A way stays if one of its nodes lies inside, and then all its nodes do; a relation stays if a member stays, at any depth, and keeps
    all members. Nodes that a way names and no input has are left out. Cycles among relations end.
    ``nodes``: (node_id, version, lon_e7, lat_e7, ...); ``ways``: (way_id, version, nodes, ...); ``members``: (relation_id, version, seq,
    member_type, member_id, role) with member_type NODE, WAY or RELATION. An element without versions has one version."""
    n, w, m = newest(nodes, "node_id"), newest(ways, "way_id"), cut(newest(members, "relation_id"))
    inside = cut(nodes_inside(n, box, areas))
    named = w.select("way_id", F.explode("nodes").alias("node_id"))
    kept_ways = cut(named.join(inside, "node_id", "left_semi").select("way_id").distinct())
    whole = inside.unionByName(named.join(kept_ways, "way_id", "left_semi").select("node_id")).distinct()
    of = lambda kind: m.where(F.col("member_type") == kind)
    step = of("NODE").join(inside, F.col("member_id") == F.col("node_id"), "left_semi").unionByName(of("WAY").join(kept_ways, F.col("member_id") == F.col("way_id"), "left_semi"))
    step = cut(step.select("relation_id").distinct())
    kept = step
    while not step.isEmpty():
        above = of("RELATION").join(step.withColumnRenamed("relation_id", "member_id"), "member_id", "left_semi").select("relation_id").distinct()
        step = cut(above.join(kept, "relation_id", "left_anti"))
        kept = kept.unionByName(step)
    return {"nodes": n.join(whole, "node_id", "left_semi"), "ways": w.join(kept_ways, "way_id", "left_semi"), "members": m.join(kept, "relation_id", "left_semi")}
