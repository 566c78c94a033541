"""Published entity tables: the schemas of the map engine's analysis interface. Identifiers are text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.functions.geometry import BOX, box_wkt, is_closed, to_wkt


def _ids(c: str | Column) -> Column:
    return F.transform(F.array_sort(F.collect_set(c)), lambda x: x.cast("string"))


def _list(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>"))


def _box() -> Column:
    return box_wkt(*[F.col(c) for c in BOX])


def parents(members: DataFrame) -> DataFrame:
    """(member_type, member_id, relations): the relations that a feature is a member of."""
    return members.groupBy("member_type", "member_id").agg(_ids("relation_id").alias("relations"))


def adjacency(edges: DataFrame) -> DataFrame:
    """(node_id, in_edges, out_edges, valence) (A12): one grouping over both ends of each edge."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("end_node").alias("node_id"), F.col("id").alias("i"), F.lit(None).cast("long").alias("o")), F.struct(F.col("start_node").alias("node_id"), F.lit(None).cast("long").alias("i"), F.col("id").alias("o")))).alias("e")).select("e.*")
    return ends.groupBy("node_id").agg(_ids("i").alias("in_edges"), _ids("o").alias("out_edges")).withColumn("valence", F.size("in_edges") + F.size("out_edges"))


def with_reverse(edges: DataFrame) -> DataFrame:
    """Adds has_reverse: an edge with the negative id exists."""
    there = edges.select((-F.col("id")).alias("id"), F.lit(True).alias("has_reverse"))
    return edges.join(there, "id", "left").withColumn("has_reverse", F.coalesce("has_reverse", F.lit(False)))


def _published(df: DataFrame, kind: str, members: DataFrame) -> DataFrame:
    p = parents(members).where(F.col("member_type") == kind).select(F.col("member_id").alias("id"), "relations")
    return df.join(p, "id", "left").withColumn("relations", _list("relations"))


def areas_df(features: DataFrame, members: DataFrame) -> DataFrame:
    """identifier, geometry, bounds, tags, relations."""
    a = _published(features.where("item_type = 'AREA'"), "AREA", members)
    return a.select(F.col("id").cast("string").alias("identifier"), to_wkt(F.col("geom"), "POLYGON").alias("geometry"), _box().alias("bounds"), "tags", "relations")


def edges_df(edges: DataFrame, members: DataFrame) -> DataFrame:
    """identifier, geometry, start, end, inEdges, outEdges, hasReverseEdge, isClosed, tags, relations (P2). inEdges end at the
    edge's start node, outEdges start at its end node (real out-edges)."""
    at = adjacency(edges)
    e = _published(with_reverse(edges), "EDGE", members)
    e = e.join(at.select(F.col("node_id").alias("start_node"), F.col("in_edges").alias("inEdges")), "start_node", "left")
    e = e.join(at.select(F.col("node_id").alias("end_node"), F.col("out_edges").alias("outEdges")), "end_node", "left")
    text = lambda c: F.col(c).cast("string")
    return e.select(
        text("id").alias("identifier"), to_wkt(F.col("geom")).alias("geometry"), text("start_node").alias("start"), text("end_node").alias("end"), "inEdges", "outEdges",
        F.col("has_reverse").alias("hasReverseEdge"), is_closed(F.col("geom")).alias("isClosed"), "tags", "relations",
    )


def lines_df(features: DataFrame, members: DataFrame) -> DataFrame:
    """identifier, geometry, bounds, isClosed, tags, relations."""
    a = _published(features.where("item_type = 'LINE'"), "LINE", members)
    return a.select(F.col("id").cast("string").alias("identifier"), to_wkt(F.col("geom")).alias("geometry"), _box().alias("bounds"), is_closed(F.col("geom")).alias("isClosed"), "tags", "relations")


def nodes_df(nodes: DataFrame, edges: DataFrame, members: DataFrame) -> DataFrame:
    """identifier, location, inEdges, outEdges, tags, relations (P4); nodes of the routing graph. ``nodes``: (node_id, lon_e7,
    lat_e7, tags)."""
    at = nodes.join(adjacency(edges), "node_id").withColumn("id", F.col("node_id"))
    point = F.array(F.struct("lon_e7", "lat_e7"))
    return _published(at, "NODE", members).select(F.col("id").cast("string").alias("identifier"), to_wkt(point, "POINT").alias("location"), F.col("in_edges").alias("inEdges"), F.col("out_edges").alias("outEdges"), "tags", "relations")


def points_df(features: DataFrame, members: DataFrame) -> DataFrame:
    """identifier, location, tags, relations (P5)."""
    a = _published(features.where("item_type = 'POINT'"), "POINT", members)
    return a.select(F.col("id").cast("string").alias("identifier"), to_wkt(F.col("geom"), "POINT").alias("location"), "tags", "relations")


def relations_df(members: DataFrame, shapes: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """identifier, geometry, memberIds, memberTypes, memberRoles, tags, relations (P6). The three member arrays are in one
    order (type, id, role). The geometry is the common box of the member shapes (member_type, member_id, box), null
    without any."""
    shaped = members.join(shapes, ["member_type", "member_id"], "left")
    agg = shaped.groupBy("relation_id").agg(
        F.array_sort(F.collect_list(F.struct("member_type", "member_id", "role"))).alias("m"),
        *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in BOX],
    )
    up = parents(members).where("member_type = 'RELATION'").select(F.col("member_id").alias("relation_id"), "relations")
    out = agg.join(up, "relation_id", "left")
    out = out.join(tags, "relation_id", "left") if tags is not None else out.withColumn("tags", F.create_map(F.lit("type"), F.lit("multipolygon")))
    pick = lambda f: F.transform("m", lambda x: x[f].cast("string"))
    return out.select(
        F.col("relation_id").cast("string").alias("identifier"), _box().alias("geometry"), pick("member_id").alias("memberIds"), pick("member_type").alias("memberTypes"),
        pick("role").alias("memberRoles"), "tags", _list("relations").alias("relations"),
    )
