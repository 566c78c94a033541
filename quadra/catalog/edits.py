"""Queries over changes, levels, snapshots and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadra import tables as T
from quadra.catalog.features import ADJ, EDGES, FEATURES, PARENTS, edges, feature_members, features, flat, road_sections, tagged_points
from quadra.catalog.tiles import GROWN, MEET, SHARD_CTE, boxed_shards
from quadra.functions import geometry as G
from quadra.functions.tags import put_tag, tags_text
from quadra.functions.tiles import tile_name
from quadra.operators import changes as C
from quadra.operators import entities, relations, snapshots, spatial
from quadra.plans import build, levels
from quadra.session import stored

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, *ctes: str, keep: bool = True, once: tuple[str, ...] = ()):
    """``keep``: derived tables that the query reads more than once are stored first, those in ``once`` are not."""

    def add(f):
        QUERIES[name] = T.keeping(f, once) if keep else f
        if sql:
            SQL[name] = T.with_prelude(sql, *ctes)
        return f

    return add


SHARDED = (
    FEATURES,
    f"sharded AS (SELECT b.country, t.zoom || '-' || t.x || '-' || t.y AS shard, f.* FROM features f JOIN tiles t ON final AND {MEET.format(a='f', b='t')} JOIN boundaries b ON {MEET.format(a='b', b='t')} AND {MEET.format(a='b', b='f')})",
)
BOXES = (SHARD_CTE, "boxes AS (SELECT country, zoom || '-' || x || '-' || y AS shard, t.* FROM shards JOIN tiles t USING (zoom, x, y))")
ESHARDED = (*EDGES, "ebox AS (SELECT id, e.way_id, start_node, end_node, min_lon_e7, min_lat_e7, max_lon_e7, max_lat_e7 FROM edges e JOIN (SELECT way_id, section, min(lon_e7) AS min_lon_e7, min(lat_e7) AS min_lat_e7, max(lon_e7) AS max_lon_e7, max(lat_e7) AS max_lat_e7 FROM parts GROUP BY ALL) USING (way_id, section))",
    f"es AS (SELECT b.country, t.zoom || '-' || t.x || '-' || t.y AS shard, f.* FROM ebox f JOIN tiles t ON final AND {MEET.format(a='f', b='t')} JOIN boundaries b ON {MEET.format(a='b', b='t')} AND {MEET.format(a='b', b='f')})")


_SIDES = ", ".join(f"sign(dx * (b.{y} - y1) - dy * (b.{x} - x1))" for x in ("min_lon_e7", "max_lon_e7") for y in ("min_lat_e7", "max_lat_e7"))
#: A segment g meets the box b.
CROSS = f"least(x1, x2) <= b.max_lon_e7 AND greatest(x1, x2) >= b.min_lon_e7 AND least(y1, y2) <= b.max_lat_e7 AND greatest(y1, y2) >= b.min_lat_e7 AND least({_SIDES}) <= 0 AND greatest({_SIDES}) >= 0"
SEGMENTS = "eseg AS (SELECT way_id, section, lon_e7 AS x1, lat_e7 AS y1, nx AS x2, ny AS y2, CAST(nx - lon_e7 AS HUGEINT) AS dx, CAST(ny - lat_e7 AS HUGEINT) AS dy FROM (SELECT *, lead(lon_e7) OVER w AS nx, lead(lat_e7) OVER w AS ny FROM parts WINDOW w AS (PARTITION BY way_id, section ORDER BY seq)) WHERE nx IS NOT NULL)"
MET = (SEGMENTS, "epart AS (SELECT id, way_id, section FROM edges)", f"met AS (SELECT DISTINCT e.country, e.shard, e.id FROM es e JOIN epart p USING (id) JOIN boxes b USING (country, shard) JOIN eseg g ON g.way_id = p.way_id AND g.section = p.section AND {CROSS})")
KEPT_EDGES = "kept_edges AS (SELECT e.* FROM ech e LEFT JOIN met m USING (country, shard, id) WHERE change_type = 'REMOVE' OR m.id IS NOT NULL)"


@T.kept
def boxes(s, d):
    """(country, shard, box) of all country shards."""
    return boxed_shards(s, d).select("country", tile_name("zoom", "x", "y").alias("shard"), *G.BOX)


@T.kept
def sharded(s, d):
    f = features(s, d).withColumns({"start_node": F.lit(None).cast("long"), "end_node": F.lit(None).cast("long")})
    return levels.shard_features(f, T.tiles(s, d), T.boundaries(s, d))


@T.kept
def sharded_edges(s, d):
    """An edge and its reverse, which have one box, are dealt to shards as one. They have their shard's box besides."""
    e = build.forward_edges(road_sections(s, d)).withColumn("item_type", F.lit("EDGE"))
    return build.both_ways(levels.shard_features(e, T.tiles(s, d), T.boundaries(s, d), "both", boxed=True))


def edge_changes(s, d):
    """Changes to edges, columns over :func:`sharded_edges`: every third way's edges are removed, the others added again; those of odd ways were made in
    another shard, those of every fifth way are not complete."""
    e = sharded_edges(s, d)
    way = F.floor(F.abs("id") / 1_000_000).cast("long")
    out = C.change(e, "ADD", "edit")
    out = out.withColumn("change_type", F.when(way % 3 == 0, "REMOVE").otherwise("ADD")).withColumn("full", (way % 5 != 0))
    return out.withColumn("source_shard", F.when(way % 2 == 0, F.col("shard")).when(way % 11 == 0, F.lit(None)).otherwise(F.lit("elsewhere"))).withColumn("mutation", F.when(way % 13 != 0, F.col("mutation")))


ECH = (*ESHARDED, """ech AS (SELECT *, CASE WHEN way_id % 3 = 0 THEN 'REMOVE' ELSE 'ADD' END AS change_type, way_id % 5 <> 0 AS whole,
 CASE WHEN way_id % 2 = 0 THEN shard WHEN way_id % 11 = 0 THEN NULL ELSE 'elsewhere' END AS source_shard, CASE WHEN way_id % 13 <> 0 THEN 'edit' END AS mutation FROM es)""")


@query("e6_sharded_features", "SELECT country, shard, item_type, id FROM sharded", *SHARDED, once=("sharded",))
def e6(s, d):
    return sharded(s, d).select(*C.KEY)


@query("c15_add_tag", "SELECT country, shard, item_type, id, 'ADD' AS change_type, tags || ';reviewed=yes' AS tags FROM sharded WHERE item_type = 'AREA'", *SHARDED, once=("sharded",))
def c15(s, d):
    m = levels.add_tag(F.col("item_type") == "AREA", "reviewed", "yes")
    return flat(m.run(sharded(s, d), None).select(*C.KEY, "change_type", "tags"))


@query("j10_assign", f"SELECT DISTINCT c.country, b.shard, c.item_type, c.id, c.shard AS source_shard FROM sharded c JOIN boxes b ON b.country = c.country AND {MEET.format(a='c', b='b')} WHERE item_type <> 'POINT'", *SHARDED, *BOXES, once=("sharded",))
def j10(s, d):
    made = C.change(sharded(s, d).where("item_type <> 'POINT'"), "ADD", "m")
    return C.assign(made, boxes(s, d)).select("country", "shard", "item_type", "id", "source_shard")


@query("p13_inside_source", f"""
SELECT c.country, c.shard, c.item_type, c.id FROM sharded c JOIN (SELECT country, min(shard) AS first FROM boxes GROUP BY 1) USING (country) JOIN boxes b ON b.country = c.country AND b.shard = first AND {MEET.format(a='c', b='b')}""", *SHARDED, *BOXES, once=("sharded",))
def p13(s, d):
    """All changes are said to come from the first shard of their country."""
    b = boxes(s, d)
    first = b.groupBy("country").agg(F.min("shard").alias("first"))
    made = C.change(sharded(s, d), "ADD", "m").join(first, "country").withColumn("source_shard", F.col("first"))
    return C.inside_source(made, b).select(*C.KEY)


_BASE = "CASE WHEN id % 2000000 = 0 THEN 'a=1;' ELSE '' END || 'b=2;landuse=forest'"


@query("a6_merge", f"SELECT country, shard, id, CASE WHEN id % 5000000 = 0 THEN 'REMOVE' ELSE 'ADD' END AS change_type, CASE WHEN id % 5000000 = 0 THEN NULL ELSE {_BASE} END AS tags FROM sharded WHERE item_type = 'AREA'", *SHARDED)
def a6(s, d):
    """Three mutations about areas: two tag them, one removes some; a removal wins over an addition."""
    a = sharded(s, d).where("item_type = 'AREA'")
    one = C.change(a.where("id % 2000000 = 0"), "ADD", "one", tags=put_tag(F.col("tags"), "a", F.lit("1")))
    two = C.change(a, "ADD", "two", tags=put_tag(F.col("tags"), "b", F.lit("2")))
    gone = C.change(a.where("id % 5000000 = 0"), "REMOVE", "gone")
    policy = C.MergePolicy(root={"ADD_REMOVE": C.remove_over_add})
    merged = C.merge(one.unionByName(two).unionByName(gone), policy)
    return merged.select("country", "shard", "id", "change_type", F.when(F.col("tags").isNotNull(), tags_text(F.col("tags"))).alias("tags"))


@query("a7_own_merge", "SELECT country, shard, id, 'ADD' AS change_type FROM sharded WHERE item_type = 'LINE'", *SHARDED, once=("sharded",))
def a7(s, d):
    """A mutation that contradicts itself, under a policy of its own that takes the left."""
    made = levels.self_conflicting(F.col("item_type") == "LINE").run(sharded(s, d), None)
    return C.merge(made, C.MergePolicy(exact={("MERGE", "ADD_REMOVE"): C.always_left}), ["mutation"]).select("country", "shard", "id", "change_type")


@query("f3_prioritize_tag", "SELECT country, shard, id, CASE WHEN id % 2000000 = 0 THEN 'landuse=park' ELSE 'landuse=meadow' END AS tags FROM sharded WHERE item_type = 'AREA'", *SHARDED, once=("sharded",))
def f3(s, d):
    """Two mutations set one tag to different values; a park wins over a meadow, and where there is none a meadow does."""
    a = sharded(s, d).where("item_type = 'AREA'")
    tag = lambda v: put_tag(F.col("tags"), "landuse", v)
    made = C.changes_of(a, ("ADD", "one", {"tags": tag(F.when(F.col("id") % 2_000_000 == 0, "park").otherwise("scrub"))}), ("ADD", "two", {"tags": tag(F.lit("meadow"))}))
    policy = C.MergePolicy(part={("MERGE", "TAGS"): C.prioritize_tag([("landuse", "park", True), ("landuse", "meadow", True)])})
    return flat(C.merge(made, policy).select("country", "shard", "id", "tags"))


@query("f4_lower_node", "SELECT country, shard, id, least(start_node, CASE WHEN id % 3 = 0 THEN start_node - 1 ELSE start_node + 1 END) AS start_node, least(end_node, end_node + 7) AS end_node FROM es", *ESHARDED, once=("sharded_edges",))
def f4(s, d):
    """Two mutations join edges to different nodes; each end takes the lower one, and the full change's line stays."""
    e = sharded_edges(s, d)
    moved = {"start_node": F.when(F.col("id") % 3 == 0, F.col("start_node") - 1).otherwise(F.col("start_node") + 1), "end_node": F.col("end_node") + 7}
    lower = C.MergePolicy(root={"START_NODE": C.lower_node_id, "END_NODE": C.lower_node_id})
    merged = C.merge(C.changes_of(e, ("ADD", "whole", {}), ("ADD", "moved", moved)), lower)
    return merged.where("full and geom is not null").select("country", "shard", "id", "start_node", "end_node")


@query("a5_changes_by_shard", "SELECT country, shard, count(*) AS n FROM ech GROUP BY ALL", *ECH, once=("sharded_edges",))
def a5(s, d):
    return edge_changes(s, d).groupBy("country", "shard").agg(F.count(F.lit(1)).alias("n"))


@query("w1_by_shard", "SELECT country, shard, id FROM ech", *ECH, once=("sharded_edges",))
def w1(s, d):
    return edge_changes(s, d).select("country", "shard", "id").repartition("country", "shard").sortWithinPartitions("country", "shard")


@query("p14_known_or_full", "SELECT country, shard, id FROM ech WHERE whole OR id % 4 <> 0", *ECH, once=("sharded_edges",))
def p14(s, d):
    """The source lacks every fourth edge."""
    return C.known_or_full(edge_changes(s, d), sharded_edges(s, d).where("id % 4 <> 0")).select("country", "shard", "id")


@query("p15_overlapping_edges", "SELECT country, shard, id, change_type FROM kept_edges", *ECH, *BOXES, *MET, KEPT_EDGES, once=("sharded_edges",))
def p15(s, d):
    return C.overlapping_edges(edge_changes(s, d), sharded_edges(s, d), None).select("country", "shard", "id", "change_type")


RELS = (
    "deep_members AS (SELECT relation_id, member_id AS way_id FROM members WHERE member_type = 'AREA' UNION SELECT a.relation_id, b.member_id FROM members a JOIN members b ON a.member_type = 'RELATION' AND b.relation_id = a.member_id AND b.member_type = 'AREA')",
    "rel_box AS (SELECT relation_id, min(min_lon_e7) AS min_lon_e7, min(min_lat_e7) AS min_lat_e7, max(max_lon_e7) AS max_lon_e7, max(max_lat_e7) AS max_lat_e7 FROM deep_members JOIN ways USING (way_id) GROUP BY 1)",
    f"rch AS (SELECT b.country, b.shard, r.relation_id AS id FROM rel_box r JOIN boxes b ON {MEET.format(a='r', b='b')})",
    f"rkept AS (SELECT DISTINCT r.* FROM rch r JOIN deep_members d ON d.relation_id = r.id JOIN ways w USING (way_id) JOIN boxes b ON b.country = r.country AND b.shard = r.shard AND {MEET.format(a='w', b='b')})",
)


@T.kept
def leaf_members(s, d):
    return relations.expand_members(feature_members(s, d))


def member_shapes(s, d):
    return features(s, d).select(F.col("item_type").alias("member_type"), F.col("id").alias("member_id"), *G.BOX)


@T.kept
def placed_relations(s, d):
    """All relations, nested ones too, in every shard that their common box meets."""
    own = leaf_members(s, d).join(member_shapes(s, d), ["member_type", "member_id"]).groupBy(F.col("relation_id").alias("id")).agg(*[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in G.BOX])
    return spatial.join_boxes(own, boxes(s, d), large=True).select(F.col("b_country").alias("country"), F.col("b_shard").alias("shard"), F.lit("RELATION").alias("item_type"), F.col("a_id").alias("id"), *[F.lit(None).cast(k).alias(v) for v, k in C.VIEW.items()], *[F.col("a_" + c).alias(c) for c in G.BOX])


def relation_changes(s, d):
    """All relations are added in their shards."""
    return C.change(placed_relations(s, d), "ADD", "m")


@query("p16_overlapping_relations", "SELECT * FROM rkept", *BOXES, *RELS)
def p16(s, d):
    """A relation stays in the shards that one of its members meets."""
    return C.overlapping_relations(relation_changes(s, d), leaf_members(s, d), member_shapes(s, d), boxes(s, d)).select("country", "shard", "id")


@query("p17_own_removals", "SELECT country, shard, id FROM ech WHERE NOT (change_type = 'REMOVE' AND source_shard IS NOT NULL AND source_shard <> shard)", *ECH, once=("sharded_edges",))
def p17(s, d):
    return C.own_removals(edge_changes(s, d)).select("country", "shard", "id")


_FOREIGN = "change_type = 'ADD' AND source_shard IS NOT NULL AND source_shard <> shard"


@query("p18_own_nodes", f"""
SELECT e.country, e.shard, e.start_node AS id FROM ech e LEFT JOIN hit h ON h.country = e.country AND h.shard = e.shard AND h.id = e.start_node WHERE NOT ({_FOREIGN.replace('shard <> shard', 'shard <> e.shard')}) OR h.id IS NOT NULL""", *ECH, *BOXES, SEGMENTS,
    "node_at AS (SELECT DISTINCT way_id, section, unnest([start_node, end_node]) AS id FROM edges)",
    f"hit AS (SELECT DISTINCT c.country, c.shard, c.start_node AS id FROM (SELECT DISTINCT country, shard, start_node FROM ech WHERE {_FOREIGN}) c JOIN node_at n ON n.id = c.start_node JOIN boxes b ON b.country = c.country AND b.shard = c.shard JOIN eseg g ON g.way_id = n.way_id AND g.section = n.section AND {CROSS})", once=("sharded_edges",))
def p18(s, d):
    ch = edge_changes(s, d).withColumn("item_type", F.lit("NODE")).withColumn("id", F.col("start_node"))
    return C.own_nodes(ch, build.forward_edges(road_sections(s, d)), None).select("country", "shard", "id")


@query("p19_without_geometric", "SELECT country, shard, id FROM ech WHERE change_type = 'REMOVE' OR way_id % 4 <> 0", *ECH, once=("sharded_edges",))
def p19(s, d):
    g = edges(s, d).where("way_id % 4 = 0").select("id")
    return C.without_geometric(edge_changes(s, d), g).select("country", "shard", "id")


@query("p20_for_log", "SELECT country, shard, id, mutation || CASE WHEN source_shard IS NULL THEN '' ELSE ':' || source_shard END AS metadata FROM ech WHERE mutation IS NOT NULL", *ECH, once=("sharded_edges",))
def p20(s, d):
    return C.for_log(edge_changes(s, d)).select("country", "shard", "id", C.metadata(None).alias("metadata"))


QUERIES["p23_metadata"], SQL["p23_metadata"] = QUERIES["p20_for_log"], SQL["p20_for_log"]
_WT = "CASE WHEN way_id % 13 <> 0 AND way_id % 3 <> 0 THEN 'highway=' || hw || CASE WHEN id % 4 = 0 THEN ';iso_country_code=' || country ELSE '' END || CASE WHEN roundabout THEN ';junction=roundabout' ELSE '' END || ';mutator:edit=0' || CASE WHEN oneway THEN ';oneway=yes' ELSE '' END ELSE 'highway=' || hw || CASE WHEN roundabout THEN ';junction=roundabout' ELSE '' END || CASE WHEN oneway THEN ';oneway=yes' ELSE '' END END"


@query("p22_mutation_tags", f"SELECT country, shard, id, {_WT} AS tags FROM ech JOIN roads USING (way_id)", *ECH, once=("sharded_edges",))
def p22(s, d):
    return flat(C.with_mutation_tags(edge_changes(s, d), sharded_edges(s, d).where("id % 4 <> 0")).select("country", "shard", "id", "tags"))


@query("p24_strip_tags", "SELECT item_type, id, tags FROM features", FEATURES)
def p24(s, d):
    marked = features(s, d).withColumn("tags", put_tag(F.col("tags"), "mutator:x", F.lit("0")))
    return flat(C.strip_mutation_tags(marked).select("item_type", "id", "tags"))


@query("p25_lift_tags", "SELECT country, shard, 'mutator:x:' || item_type || ':' || id AS key, '3' AS value FROM sharded WHERE item_type = 'AREA'", *SHARDED, once=("sharded",))
def p25(s, d):
    return C.lift_mutation_tags(sharded(s, d).where("item_type = 'AREA'").withColumn("tags", put_tag(F.col("tags"), "mutator:x", F.lit("3"))))


@query("p26_backfill", "SELECT country, shard, id, true AS has_shape FROM ech", *ECH, once=("sharded_edges",))
def p26(s, d):
    bare = edge_changes(s, d).withColumn("geom", F.lit(None).cast(G.POINTS))
    return C.with_shapes(bare, sharded_edges(s, d)).select("country", "shard", "id", F.col("shape").isNotNull().alias("has_shape"))


@query("c7_generated_removes", "SELECT e.country, e.shard, e.id, 'REMOVE' AS change_type FROM es e LEFT JOIN ech c ON c.country = e.country AND c.shard = e.shard AND c.id = e.id AND c.id % 2 = 0 LEFT JOIN moved_met m ON m.country = e.country AND m.shard = e.shard AND m.id = e.id WHERE c.id IS NULL AND m.id IS NULL", *ECH, *BOXES, *MET,
    f"moved_met AS (SELECT DISTINCT e.country, e.shard, e.id FROM es e JOIN epart p USING (id) JOIN boxes b USING (country, shard) JOIN (SELECT eseg.way_id, eseg.section, k, x1 + k * 500000000 AS x1, x2 + k * 500000000 AS x2, y1, y2, dx, dy FROM eseg, (SELECT unnest([0, 1]) AS k)) g ON g.way_id = p.way_id AND g.section = p.section AND k = CASE WHEN e.id % 9 = 0 THEN 1 ELSE 0 END AND {CROSS})", once=("sharded_edges",))
def c7(s, d):
    """Every ninth edge has moved away from its shards; the others stay where their line meets the shard."""
    lon = F.when(F.col("id") % 9 == 0, 500_000_000).otherwise(0)
    moved = sharded_edges(s, d).withColumn("geom", F.transform("geom", lambda p: F.struct((p["lon_e7"] + lon).cast("long").alias("lon_e7"), p["lat_e7"].alias("lat_e7"))))
    moved = moved.withColumns(G.bounds(F.col("geom")))
    return C.generated_removes(edge_changes(s, d).where("id % 2 = 0"), moved, None).select("country", "shard", "id", "change_type")


@query("c8_filter_changes", f"""
SELECT country, shard, 'EDGE' AS item_type, id, change_type FROM final_edges UNION ALL SELECT country, shard, 'RELATION', id, 'ADD' FROM rkept
UNION ALL SELECT e.country, e.shard, 'EDGE', e.id, 'REMOVE' FROM es e LEFT JOIN final_edges c USING (country, shard, id) LEFT JOIN met m USING (country, shard, id) WHERE c.id IS NULL AND m.id IS NULL""", *ECH, *BOXES, *MET, KEPT_EDGES, *RELS,
    "final_edges AS (SELECT * FROM kept_edges WHERE NOT (change_type = 'REMOVE' AND source_shard IS NOT NULL AND source_shard <> shard))")
def c8(s, d):
    """Changes to edges and relations through all filters."""
    ch = edge_changes(s, d).select(*C.CHANGE).unionByName(relation_changes(s, d))
    out = C.filter_changes(ch, sharded_edges(s, d), build.forward_edges(road_sections(s, d)), boxes(s, d), leaves=leaf_members(s, d), shapes=member_shapes(s, d), tiles=True)
    return out.select("country", "shard", "item_type", "id", "change_type")


@query("c9_apply", "SELECT country, shard, item_type, id, CASE WHEN item_type = 'AREA' THEN tags || ';seen=1' ELSE tags END AS tags FROM sharded WHERE NOT (item_type = 'POINT' AND id % 3000000 = 0)", *SHARDED, once=("sharded",))
def c9(s, d):
    f = sharded(s, d)
    ch = C.change(f.where("item_type = 'AREA'"), "ADD", "m", tags=put_tag(F.col("tags"), "seen", F.lit("1"))).unionByName(C.change(f.where("item_type = 'POINT' and id % 3000000 = 0"), "REMOVE", "m"))
    return flat(C.apply_changes(f, ch, None).select(*C.KEY, "tags"))


QUERIES["u1_changed_and_untouched"], SQL["u1_changed_and_untouched"] = QUERIES["c9_apply"], SQL["c9_apply"]


@query("c10_new_shards", "SELECT country, shard FROM ech GROUP BY ALL HAVING bool_or(change_type = 'ADD' AND whole) AND bool_and(shard NOT LIKE '%1')", *ECH, once=("sharded_edges",))
def c10(s, d):
    """Shards whose name ends in 1 exist already."""
    ch = stored(edge_changes(s, d).groupBy("country", "shard", "change_type", "full").agg(F.count(F.lit(1)).alias("n")), "kinds")
    return C.new_shards(ch, ch.where("shard like '%1'"))


@query("c11_side_output", "SELECT country, shard, id FROM sharded WHERE item_type = 'AREA'", *SHARDED, once=("sharded",))
def c11(s, d):
    return C.side_output(sharded(s, d), F.col("item_type") == "AREA").select("country", "shard", "id")


def _level(s, d, only=None):
    ms = [levels.add_tag(F.col("item_type") == "AREA", "reviewed", "yes"), levels.remove_points("amenity", "click")]
    return sharded(s, d), ms, levels.Context(boxes(s, d), tiles=True), only


_C12 = "SELECT country, shard, item_type, id, CASE WHEN item_type = 'AREA' THEN tags || ';mutator:add_tag=0;reviewed=yes' ELSE tags END AS tags FROM sharded WHERE NOT (item_type = 'POINT' AND tags = 'amenity=click')"


@query("c12_level_run", _C12, *SHARDED)
def c12(s, d):
    f, ms, ctx, _ = _level(s, d)
    return flat(levels.run_level(f, ms, ctx)[0].select(*C.KEY, "tags"))


@query("c13_one_shard", _C12.replace("CASE WHEN item_type = 'AREA' THEN", "CASE WHEN item_type = 'AREA' AND (item_type, id) IN (SELECT (item_type, id) FROM sharded WHERE shard LIKE '%0') THEN").replace("tags = 'amenity=click')", "tags = 'amenity=click' AND (item_type, id) IN (SELECT (item_type, id) FROM sharded WHERE shard LIKE '%0'))"), *SHARDED)
def c13(s, d):
    """Mutations read only the shards whose name ends in 0; what they change lies in neighbours too."""
    f, ms, ctx, _ = _level(s, d)
    return flat(levels.run_level(f, ms, ctx, only=F.col("shard").endswith("0"))[0].select(*C.KEY, "tags"))


@query("c12_level_with_neighbours", """
SELECT s.country, s.shard, s.item_type, s.id, CASE WHEN item_type = 'AREA' AND t.id IS NOT NULL THEN tags || ';mutator:tag_near=0;near=yes' ELSE tags END AS tags
FROM sharded s LEFT JOIN tagged t ON t.country = s.country AND t.id = s.id AND s.item_type = 'AREA'""", *SHARDED, *BOXES, GROWN,
    f"near AS (SELECT DISTINCT a.country, a.shard FROM (SELECT s.country, g.zoom || '-' || g.x || '-' || g.y AS shard, g.* EXCLUDE (zoom, x, y) FROM shards s JOIN grown g USING (zoom, x, y)) a JOIN boxes b ON a.country = b.country AND {MEET.format(a='a', b='b')} JOIN sharded f ON f.country = b.country AND f.shard = b.shard WHERE f.item_type = 'POINT' AND f.id % 7000000 = 0)",
    "tagged AS (SELECT DISTINCT country, id FROM sharded JOIN near USING (country, shard) WHERE item_type = 'AREA')")
def c12_neighbours(s, d):
    """Areas are tagged where a seventh point lies in their shard or within five kilometres of it: neighbours are fetched."""
    f, _, ctx, _ = _level(s, d)
    m = levels.tag_near(F.col("item_type") == "AREA", (F.col("item_type") == "POINT") & (F.col("id") % 7_000_000 == 0), 5000.0, "near")
    return flat(levels.run_level(f, [m], ctx)[0].select(*C.KEY, "tags"))


@query("e7_levels", _C12.replace("';mutator:add_tag=0;reviewed=yes'", "';mutator:add_tag=0;mutator:second=1;reviewed=yes;second=yes'"), *SHARDED)
def e7(s, d):
    """Two levels: the second mutation reads the tag that the first one sets."""
    f, ms, ctx, _ = _level(s, d)
    from quadra.functions.tags import has_tag

    second = levels.add_tag(has_tag("reviewed"), "second", "yes", "second")
    ms = [*ms, levels.Mutation("second", second.run, depends=("add_tag", "unknown"))]
    return flat(levels.run_levels(f, ms, ctx).select(*C.KEY, "tags"))


@query("c16_validate", "SELECT 'edge without node' AS problem, 'EDGE' AS item_type, id FROM edges WHERE start_node % 50 = 0 OR end_node % 50 = 0 UNION SELECT 'member without feature', 'RELATION', relation_id FROM members WHERE member_type = 'AREA' AND member_id % 5 = 0 OR member_type = 'RELATION'", *EDGES)
def c16(s, d):
    """Every 50th node and every area of a fifth way are taken away; relations are no features here."""
    f = features(s, d).where("item_type = 'AREA' and id % 5000000 <> 0").select("item_type", "id", F.lit(None).cast("long").alias("start_node"), F.lit(None).cast("long").alias("end_node"))
    e = edges(s, d).select(F.lit("EDGE").alias("item_type"), "id", "start_node", "end_node")
    return C.validate(f.unionByName(e), T.nodes(s, d).where("node_id % 50 <> 0"), feature_members(s, d))


# ---------------------------------------------------------------- joins


@query("j4_neighbour_fetch", f"SELECT a.country, a.shard AS origin, f.shard, f.item_type, f.id FROM boxes a JOIN boxes b ON a.country = b.country AND {MEET.format(a='a', b='b')} JOIN sharded f ON f.country = b.country AND f.shard = b.shard WHERE f.item_type = 'AREA'", *SHARDED, *BOXES, once=("sharded",))
def j4(s, d):
    b = boxes(s, d)
    req = spatial.join_boxes(b, b, [("country", "country")], large=True).select(F.col("a_country").alias("country"), F.col("a_shard").alias("origin"), F.col("b_shard").alias("neighbour"))
    return spatial.fetch(req, sharded(s, d).where("item_type = 'AREA'")).select("country", "origin", "shard", "item_type", "id")


@query("a8_duplicate_requests", "SELECT country, shard AS origin, shard AS neighbour, 2 AS n FROM boxes WHERE shard LIKE '%7'", *BOXES)
def a8(s, d):
    req = spatial.neighbours(boxes(s, d), 0)
    return spatial.duplicate_requests(req.unionByName(req.where("origin like '%7'")))


@query("j5_changes_with_groups", "SELECT country, shard, id, n FROM (SELECT * FROM sharded WHERE item_type = 'AREA') c LEFT JOIN (SELECT country, shard, count(*) AS n FROM sharded WHERE item_type = 'LINE' GROUP BY ALL) USING (country, shard)", *SHARDED, once=("sharded",))
def j5(s, d):
    f = sharded(s, d)
    groups = f.where("item_type = 'LINE'").groupBy("country", "shard").agg(F.count(F.lit(1)).alias("n"))
    return C.changes_with_neighbours(f.where("item_type = 'AREA'").select("country", "shard", "id"), groups)


@query("j6_untouched", "SELECT country, shard FROM boxes EXCEPT SELECT country, shard FROM sharded WHERE item_type = 'AREA'", *SHARDED, *BOXES, once=("sharded",))
def j6(s, d):
    return C.untouched(boxes(s, d).select("country", "shard"), sharded(s, d).where("item_type = 'AREA'"))


@query("j7_missing_shards", "SELECT country, shard FROM boxes WHERE country <> 'N03' EXCEPT SELECT country, shard FROM sharded", *SHARDED, *BOXES, once=("sharded",))
def j7(s, d):
    return snapshots.missing_shards(boxes(s, d).select("country", "shard"), sharded(s, d).select("country", "shard"), exclude=["N03"])


QUERIES["u4_shard_difference"], SQL["u4_shard_difference"] = QUERIES["j7_missing_shards"], SQL["j7_missing_shards"]


@query("p11_countries", "SELECT country, shard FROM boxes WHERE country IN ('N01', 'N02')", *BOXES)
def p11(s, d):
    return snapshots.countries(boxes(s, d).select("country", "shard"), ["N01", "N02"], ["N05"])


@query("j8_missing_files", "SELECT zoom || '-' || x || '-' || y || '.pbf' AS name, 'missing' AS problem FROM tree LEFT JOIN tile_counts c USING (zoom, x, y) WHERE final AND c.n IS NULL UNION ALL SELECT zoom || '-' || x || '-' || y || '.pbf', 'empty' FROM tile_counts WHERE n % 7 = 0")
def j8(s, d):
    """Expected: a file for each leaf. Listed: tiles with nodes, those with a multiple of seven nodes as empty files."""
    name = F.concat(tile_name("zoom", "x", "y"), F.lit(".pbf")).alias("name")
    n = T.nodes(s, d)
    files = T.tile_counts(n).select(name, F.when(F.col("n") % 7 == 0, 0).otherwise(F.col("n")).alias("length"))
    return snapshots.missing_files(T.build_tree(n).where("final").select(name), files)


@query("j12_all_countries", "SELECT for_country, shard AS origin, shard, item_type, id, min(country) AS country FROM (SELECT DISTINCT country AS for_country, shard FROM boxes) JOIN sharded USING (shard) WHERE item_type = 'AREA' GROUP BY ALL", *SHARDED, *BOXES, once=("sharded",))
def j12(s, d):
    req = spatial.neighbours(boxes(s, d), 0)
    return spatial.fetch_all_countries(req, sharded(s, d).where("item_type = 'AREA'")).select("for_country", "origin", "shard", "item_type", "id", "country")


@query("j13_lookup", "SELECT country, count(*) AS n FROM sharded JOIN boundaries b USING (country) WHERE b.min_lat_e7 >= 0 GROUP BY 1", *SHARDED, once=("sharded",))
def j13(s, d):
    ctx = levels.Context(None, {"north": T.boundaries(s, d).where("min_lat_e7 >= 0").select("country")})
    return sharded(s, d).join(ctx.lookup("north", 1 << 20), "country").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query("j16_connected", "SELECT DISTINCT id AS edge_id, node_id FROM (SELECT id, start_node AS node_id FROM edges UNION ALL SELECT id, end_node FROM edges)", *EDGES)
def j16(s, d):
    """A third of the edges is known only from the change set."""
    e = edges(s, d)
    return C.connected_edges(T.nodes(s, d), e.where("way_id % 3 <> 0"), e)


@query("j17_floaters", "SELECT id FROM edges WHERE abs(id) NOT IN (SELECT e FROM ends WHERE node IN (SELECT node FROM ends GROUP BY 1 HAVING count(*) > 1))", *EDGES, "ends AS (SELECT DISTINCT abs(id) AS e, unnest([start_node, end_node]) AS node FROM edges)")
def j17(s, d):
    return C.floaters(edges(s, d))


FLOATING = (
    "ends AS (SELECT DISTINCT abs(id) AS e, unnest([start_node, end_node]) AS node FROM edges)",
    "gone AS (SELECT * FROM edges WHERE abs(id) NOT IN (SELECT e FROM ends WHERE node IN (SELECT node FROM ends GROUP BY 1 HAVING count(*) > 1)))",
)


@query("j17_floater_removes", "SELECT 'EDGE' AS item_type, id, 'REMOVE' AS change_type FROM gone UNION ALL SELECT DISTINCT 'NODE', unnest([start_node, end_node]), 'REMOVE' FROM gone", *EDGES, *FLOATING, keep=True)
def j17_removes(s, d):
    return C.floater_removes(edges(s, d))


@query("j18_turn_restrictions", """
SELECT node_id, f AS from_edge, t AS to_edge FROM (SELECT a.end_node AS node_id, a.id AS f, b.id AS t, row_number() OVER (PARTITION BY a.end_node ORDER BY a.id, b.id) AS rn
 FROM edges a JOIN edges b ON b.start_node = a.end_node AND a.id <> -b.id JOIN ins ON ins.node_id = a.end_node JOIN outs ON outs.node_id = a.end_node WHERE ni + no > 3) WHERE rn = 1""", *EDGES, *ADJ)
def j18(s, d):
    e = edges(s, d)
    return C.turn_restrictions(e, entities.adjacency(e), 3)


QUERIES["w3_first_pairs"], SQL["w3_first_pairs"] = QUERIES["j18_turn_restrictions"], SQL["j18_turn_restrictions"]


@query("p12_polygon_filter", f"SELECT way_id FROM ways w WHERE EXISTS (SELECT 1 FROM boundaries b WHERE country IN ('N07', 'N12') AND {MEET.format(a='w', b='b')}) AND NOT EXISTS (SELECT 1 FROM boundaries b WHERE country = 'N13' AND {MEET.format(a='w', b='b')})")
def p12(s, d):
    w, b = T.ways(s, d).select("way_id", *G.BOX), T.boundaries(s, d)
    at = lambda names: spatial.join_boxes(w, b.where(F.col("country").isin(names))).select(F.col("a_way_id").alias("way_id"))
    return w.select("way_id").join(at(["N07", "N12"]), "way_id", "left_semi").join(at(["N13"]), "way_id", "left_anti")


@query("p12_outline_filter", "SELECT DISTINCT p.id FROM points p JOIN rects b ON country IN ('N06', 'N07') AND lon_e7 BETWEEN min_lon_e7 AND max_lon_e7 AND lat_e7 BETWEEN min_lat_e7 AND max_lat_e7")
def p12_outlines(s, d):
    """Points that meet a polygon of two countries, its border included."""
    p = tagged_points(s, d).select("id", *[F.col("lon_e7" if "lon" in c else "lat_e7").alias(c) for c in G.BOX])
    pairs = spatial.join_boxes(p, T.outlines(s, d).where(F.col("country").isin("N06", "N07")))
    return pairs.where(G.region_meets_box(F.col("b_outer"), F.col("b_holes"), G.box_columns("a_"))).select(F.col("a_id").alias("id")).distinct()


@query("p10_input_filters", "SELECT way_id FROM ways WHERE kind = 'road' AND hw <> 'service'")
def p10(s, d):
    from quadra.functions.tags import has_tag
    from quadra.plans.build import read_raw

    return read_raw(T.ways(s, d), rule=has_tag("highway") & ~has_tag("highway", "service")).select("way_id")


@query("p27_ignored_nodes", "SELECT node_id FROM nodes WHERE node_id NOT IN (SELECT node_id FROM nodes WHERE node_id % 9 = 0)")
def p27(s, d):
    n = T.nodes(s, d)
    return n.join(n.where("node_id % 9 = 0").select("node_id"), "node_id", "left_anti").select("node_id")


@query("p28_include_lists", "SELECT country, shard, id FROM ech WHERE shard IN (SELECT min(shard) FROM ech UNION ALL SELECT max(shard) FROM ech) AND mutation IN ('edit')", *ECH, once=("sharded_edges",))
def p28(s, d):
    ch = edge_changes(s, d)
    ends = stored(ch.agg(F.explode(F.array(F.min("shard"), F.max("shard"))).alias("shard")), "ends")
    return ch.join(ends, "shard", "left_semi").where(F.col("mutation").isin("edit")).select("country", "shard", "id")


@query("u2_united_inputs", "SELECT way_id, kind FROM ways")
def u2(s, d):
    from quadra.plans.build import read_raw

    w = T.ways(s, d)
    return read_raw(w.where("kind = 'road'"), None, w.where("kind = 'AREA'"), w.where("kind = 'LINE'"), keep_all=True).select("way_id", "kind")


@query("u5_with_removes", "SELECT change_type, CAST(sum(n) AS BIGINT) AS n FROM (SELECT change_type, count(*) AS n FROM ech GROUP BY 1 UNION ALL SELECT 'REMOVE', count(*) FROM es e LEFT JOIN ech c USING (country, shard, id) LEFT JOIN met m USING (country, shard, id) WHERE c.id IS NULL AND m.id IS NULL) WHERE n > 0 GROUP BY 1", *ECH, *BOXES, *MET, once=("sharded_edges",))
def u5(s, d):
    ch = edge_changes(s, d)
    return ch.select(*C.CHANGE).unionByName(C.generated_removes(ch, sharded_edges(s, d), None)).groupBy("change_type").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- snapshots, statistics, checks


_DIFF = """diff AS (SELECT coalesce(n.way_id, p.way_id) AS way_id, CASE WHEN p.way_id IS NULL THEN 'ADDED' WHEN n.way_id IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS kind,
 p.kind AS old_kind, p.highway AS old_highway, n.kind AS new_kind, n.highway AS new_highway FROM snapshot n FULL JOIN previous p ON n.way_id = p.way_id
 WHERE p.way_id IS NULL OR n.way_id IS NULL OR p.kind IS DISTINCT FROM n.kind OR p.highway IS DISTINCT FROM n.highway)"""


def _diff(s, d):
    return snapshots.diff(T.previous(s, d), T.snapshot(s, d), ["way_id"], ["kind", "highway"])


@query("j19_snapshot_diff", "SELECT * FROM diff", _DIFF)
def j19(s, d):
    return _diff(s, d)


@query("s12_previous", "SELECT * FROM previous")
def s12(s, d):
    return T.previous(s, d)


@query("a11_diff_summary", "SELECT kind, coalesce(new_kind, old_kind) AS item, count(*) AS n FROM diff GROUP BY ALL", _DIFF)
def a11(s, d):
    return snapshots.diff_summary(_diff(s, d).withColumn("item", F.coalesce("new_kind", "old_kind")), ["item"])


@query("k7_delta", "SELECT way_id FROM diff WHERE kind = 'REMOVED'", _DIFF)
def k7(s, d):
    return _diff(s, d).where("kind = 'REMOVED'").select("way_id")


_STATS = "stats AS (SELECT country, shard, item_type, 'all' AS key, count(*) AS n FROM sharded GROUP BY ALL UNION ALL SELECT country, shard, item_type, 'landuse', count(*) FROM sharded WHERE tags LIKE 'landuse=%' GROUP BY ALL UNION ALL SELECT country, shard, item_type, 'amenity', count(*) FROM sharded WHERE tags LIKE 'amenity=%' GROUP BY ALL)"


@query("a9_shard_statistics", "SELECT * FROM stats", *SHARDED, _STATS)
def a9(s, d):
    return snapshots.shard_statistics(sharded(s, d), ["landuse", "amenity"])


@query("a10_country_statistics", "SELECT country, item_type, key, CAST(sum(n) AS BIGINT) AS n FROM stats GROUP BY ALL", *SHARDED, _STATS)
def a10(s, d):
    return snapshots.country_statistics(snapshots.shard_statistics(sharded(s, d), ["landuse", "amenity"]))


@query("k11_log_manifest", "SELECT country, 'logs/' || country || '-' || level || '-applied/' || country || '-' || level || '-applied_' || shard || '.geojson.gz' AS path FROM boxes, (SELECT unnest([0, 1, 2]) AS level)", *BOXES)
def k11(s, d):
    return snapshots.log_manifest(s.range(3).select(F.col("id").alias("level")), boxes(s, d).select("country", "shard"))
