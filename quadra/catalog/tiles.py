"""Queries over tiles, trees and boundaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadra import tables as T
from quadra.functions import geometry as G
from quadra.functions import tiles as X
from quadra.operators import spatial, trees

TILE_KEY = ["zoom", "x", "y"]
QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, *ctes: str, keep: bool = False):
    """``keep``: derived tables that the query reads more than once are stored first."""

    def add(f):
        QUERIES[name] = T.keeping(f) if keep else f
        if sql:
            SQL[name] = T.with_prelude(sql, *ctes)
        return f

    return add


_x9, _y9 = T.sql_tile("lon_e7", "lat_e7", "9")
SHARD_CTE = "shards AS (SELECT country, zoom, x, y FROM tiles t JOIN boundaries b ON t.final AND t.min_lon_e7 <= b.max_lon_e7 AND b.min_lon_e7 <= t.max_lon_e7 AND t.min_lat_e7 <= b.max_lat_e7 AND b.min_lat_e7 <= t.max_lat_e7)"


def country_shards(s, d):
    return spatial.country_shards(T.tiles(s, d), T.boundaries(s, d))


def boxed_shards(s, d):
    """With the box of each tile."""
    return spatial.country_shards(T.tiles(s, d), T.boundaries(s, d), G.BOX)


@query("shard_statistics", f"""
SELECT b.country, x, y, count(*) AS way_nodes, count(DISTINCT way_id) AS ways
FROM (SELECT *, {_x9} AS x, {_y9} AS y FROM way_nodes) n
JOIN boundaries b ON lon_e7 >= min_lon_e7 AND lon_e7 < max_lon_e7 AND lat_e7 >= min_lat_e7 AND lat_e7 < max_lat_e7 GROUP BY ALL""")
def shard_statistics(s, d):
    """Flagship: way nodes and ways by country and tile of zoom 9."""
    n = T.with_country(T.way_nodes(s, d), T.boundaries(s, d))
    n = n.withColumns({"x": X.tile_x("lon_e7", F.lit(9)), "y": X.tile_y("lat_e7", F.lit(9))})
    return n.groupBy("country", "x", "y").agg(F.count(F.lit(1)).alias("way_nodes"), F.count_distinct("way_id").alias("ways"))


@query("x1_tile_bounds", "SELECT zoom, x, y, min_lon_e7, min_lat_e7, max_lon_e7, max_lat_e7 FROM tiles")
def x1(s, d):
    return T.tiles(s, d).drop("final")


@query("x2_tile_of", f"SELECT node_id, 9 AS zoom, {_x9} AS x, {_y9} AS y FROM nodes")
def x2(s, d):
    return T.nodes(s, d).select("node_id", X.tile_of("lon_e7", "lat_e7", F.lit(9)).alias("t")).select("node_id", "t.*")


def _sql_geohash(p: int) -> str:
    bits = 5 * p
    nlon, nlat = (bits + 1) // 2, bits // 2
    bit = lambda i: f"(({'lo' if i % 2 == 0 else 'la'} >> {(nlon if i % 2 == 0 else nlat) - 1 - i // 2}) & 1)"
    letters = [f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(1 + {' + '.join(f'{1 << (4 - b)} * {bit(5 * j + b)}' for b in range(5))} AS INTEGER), 1)" for j in range(p)]
    lo = f"CAST(least(floor((CAST(lon_e7 AS DOUBLE) + 1800000000.0) * ({2.0**nlon!r}::DOUBLE / 3600000000.0)), {2**nlon - 1}) AS BIGINT)"
    la = f"CAST(least(floor((CAST(lat_e7 AS DOUBLE) + 900000000.0) * ({2.0**nlat!r}::DOUBLE / 1800000000.0)), {2**nlat - 1}) AS BIGINT)"
    return f"SELECT node_id, {' || '.join(letters)} AS geohash FROM (SELECT node_id, {lo} AS lo, {la} AS la FROM nodes)"


@query("x3_geohash", _sql_geohash(5))
def x3(s, d):
    return T.nodes(s, d).select("node_id", X.geohash("lon_e7", "lat_e7", 5).alias("geohash"))


@query("x4_shards_of_bbox", """
SELECT way_id, zoom, x, y FROM ways w JOIN tiles t ON final AND w.min_lon_e7 <= t.max_lon_e7 AND t.min_lon_e7 <= w.max_lon_e7
AND w.min_lat_e7 <= t.max_lat_e7 AND t.min_lat_e7 <= w.max_lat_e7""")
def x4(s, d):
    return spatial.shards_of_boxes(T.ways(s, d), T.tiles(s, d), ["way_id"])


@query("x5_names", """
SELECT country || '_' || zoom || '-' || x || '-' || y AS name, CAST(zoom AS INTEGER) AS zoom, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM shards""", SHARD_CTE)
def x5(s, d):
    named = country_shards(s, d).select(X.country_shard("country", "zoom", "x", "y").alias("name"))
    return named.select("name", X.parse_tile("name").alias("t")).select("name", "t.*")


@query("x6_expand_bbox", """
SELECT zoom, x, y,
 greatest(min_lon_e7 - CAST(ceil(5000.0::DOUBLE / (111320.0::DOUBLE * greatest(cos(radians(greatest(abs(min_lat_e7), abs(max_lat_e7)) / 10000000.0::DOUBLE)), 0.01)) * 10000000.0) AS BIGINT), -1800000000) AS min_lon_e7,
 greatest(min_lat_e7 - CAST(ceil(5000.0::DOUBLE / 111320.0::DOUBLE * 10000000.0) AS BIGINT), -900000000) AS min_lat_e7,
 least(max_lon_e7 + CAST(ceil(5000.0::DOUBLE / (111320.0::DOUBLE * greatest(cos(radians(greatest(abs(min_lat_e7), abs(max_lat_e7)) / 10000000.0::DOUBLE)), 0.01)) * 10000000.0) AS BIGINT), 1800000000) AS max_lon_e7,
 least(max_lat_e7 + CAST(ceil(5000.0::DOUBLE / 111320.0::DOUBLE * 10000000.0) AS BIGINT), 900000000) AS max_lat_e7
FROM tiles""")
def x6(s, d):
    return T.tiles(s, d).select(*TILE_KEY, *[v.alias(k) for k, v in X.expand_bbox(*G.BOX, F.lit(5000.0)).items()])


@query("x7_loading_areas", """
SELECT s.country, s.zoom, s.x, s.y, greatest(t.min_lon_e7, b.min_lon_e7) AS min_lon_e7, greatest(t.min_lat_e7, b.min_lat_e7) AS min_lat_e7,
 least(t.max_lon_e7, b.max_lon_e7) AS max_lon_e7, least(t.max_lat_e7, b.max_lat_e7) AS max_lat_e7
FROM shards s JOIN tiles t USING (zoom, x, y) JOIN boundaries b ON b.country = s.country
WHERE greatest(t.min_lon_e7, b.min_lon_e7) < least(t.max_lon_e7, b.max_lon_e7) AND greatest(t.min_lat_e7, b.min_lat_e7) < least(t.max_lat_e7, b.max_lat_e7)""", SHARD_CTE, keep=True)
def x7(s, d):
    shards = boxed_shards(s, d)
    return spatial.loading_areas(shards, T.boundaries(s, d))


@query("x15_tile_feature", f"""
SELECT zoom, x, y, '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[[' ||
 '[' || lo0 || ',' || la0 || '],[' || lo0 || ',' || la1 || '],[' || lo1 || ',' || la1 || '],[' || lo1 || ',' || la0 || '],[' || lo0 || ',' || la0 || ']' ||
 ']]}},"properties":{{"shard":"' || zoom || '-' || x || '-' || y || '"}}}}' AS feature
FROM (SELECT *, {T.sql_degrees('min_lon_e7')} AS lo0, {T.sql_degrees('min_lat_e7')} AS la0, {T.sql_degrees('max_lon_e7')} AS lo1, {T.sql_degrees('max_lat_e7')} AS la1 FROM tiles)""")
def x15(s, d):
    return T.tiles(s, d).select(*TILE_KEY, X.tile_feature("zoom", "x", "y").alias("feature"))


@query("k2_shard_path", """
SELECT zoom, x, y, zoom || '-' || x || '-' || y || '.pbf' AS flat, zoom || '/' || x || '-' || y || '.osm.pbf' AS slash,
 zoom || '/' || x || '/' || y || '/' || zoom || '-' || x || '-' || y || '.pbf' AS sub, zoom || '/' AS folder, '' AS empty FROM tiles""")
def k2(s, d):
    p = lambda n: X.shard_path("zoom", "x", "y", n)
    return T.tiles(s, d).select(*TILE_KEY, p("ZZ_XX_YY_PBF").alias("flat"), p("zz/xx-yy.osm.pbf").alias("slash"), p("ZZ_XX_YY_SUBFOLDERS_PBF").alias("sub"), p("zz/").alias("folder"), p("EMPTY").alias("empty"))


@query("a14_tree_statistics", """
SELECT x >> (zoom - 2) AS x, y >> (zoom - 2) AS y, count(*) AS leaves, min(zoom) AS min_zoom, max(zoom) AS max_zoom
FROM tree WHERE final AND zoom >= 2 GROUP BY ALL""")
def a14(s, d):
    return trees.subtree_statistics(T.build_tree(T.nodes(s, d)), 2)


@query("a15_tree_consistency", """
SELECT k.zoom, k.x, k.y, 'missing' AS problem FROM kids k LEFT JOIN t USING (zoom, x, y) WHERE t.zoom IS NULL
UNION ALL SELECT t.zoom, t.x, t.y, 'orphan' FROM t LEFT JOIN kids k USING (zoom, x, y) WHERE t.zoom > 0 AND k.zoom IS NULL""",
    "t AS (SELECT * FROM tree WHERE (zoom + x + y) % 5 <> 0)",
    "kids AS (SELECT zoom + 1 AS zoom, 2 * x + dx AS x, 2 * y + dy AS y FROM t, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) d(dx, dy) WHERE NOT final)")
def a15(s, d):
    """The tree with every fifth tile taken away, so that there is something to find."""
    return trees.inconsistencies(T.build_tree(T.nodes(s, d)).where("(zoom + x + y) % 5 <> 0"))


@query("a16_split_leaves", """
SELECT zoom, x, y, final AND NOT cut AS final, false AS new FROM c
UNION ALL SELECT zoom + 1, 2 * x + dx, 2 * y + dy, true, true FROM c, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) d(dx, dy) WHERE cut""",
    "c AS (SELECT tree.*, final AND coalesce(n, 0) > 100 AND tree.zoom < 14 AS cut FROM tree LEFT JOIN tile_counts USING (zoom, x, y))")
def a16(s, d):
    n = T.nodes(s, d)
    return trees.split_leaves(T.build_tree(n), T.tile_counts(n).withColumnRenamed("n", "size"), 100)


@query("a17_build_tree", "SELECT zoom, x, y, final FROM tree")
def a17(s, d):
    return T.build_tree(T.nodes(s, d))


@query("a18_subtrees", "SELECT zoom, x, y, final FROM tree WHERE zoom = 3")
def a18(s, d):
    return trees.subtrees(T.build_tree(T.nodes(s, d)), 3)


@query("a13_shard_count", "SELECT country, count(*) AS shards FROM shards GROUP BY country", SHARD_CTE)
def a13(s, d):
    return country_shards(s, d).distinct().groupBy("country").agg(F.count(F.lit(1)).alias("shards"))


@query("j1_country_shards", "SELECT * FROM shards", SHARD_CTE)
def j1(s, d):
    return country_shards(s, d)


@query("j2_tasks", """
SELECT country, zoom || '-' || x || '-' || y AS shard, count(*) OVER (PARTITION BY country) AS n_shards FROM shards""", SHARD_CTE)
def j2(s, d):
    return spatial.tasks(country_shards(s, d)).select("country", "shard", F.size("all_shards").cast("long").alias("n_shards"))


REL_CTE = """rel AS (SELECT relation_id, min(min_lon_e7) AS min_lon_e7, min(min_lat_e7) AS min_lat_e7, max(max_lon_e7) AS max_lon_e7, max(max_lat_e7) AS max_lat_e7
 FROM members JOIN ways ON member_type = 'AREA' AND way_id = member_id GROUP BY relation_id)"""
MEET = "{a}.min_lon_e7 <= {b}.max_lon_e7 AND {b}.min_lon_e7 <= {a}.max_lon_e7 AND {a}.min_lat_e7 <= {b}.max_lat_e7 AND {b}.min_lat_e7 <= {a}.max_lat_e7"


def relation_boxes(s, d):
    m = T.members(s, d).where("member_type = 'AREA'").select("relation_id", F.col("member_id").alias("way_id"))
    return m.join(T.ways(s, d), "way_id").groupBy("relation_id").agg(*[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in G.BOX])


@query("j9_fan_out", f"""
SELECT relation_id, b.country, t.zoom, t.x, t.y FROM rel r JOIN tiles t ON final AND {MEET.format(a='r', b='t')}
JOIN boundaries b ON {MEET.format(a='b', b='t')} AND {MEET.format(a='b', b='r')}""", REL_CTE, keep=True)
def j9(s, d):
    return spatial.fan_out(relation_boxes(s, d), T.tiles(s, d), T.boundaries(s, d))


@query("j11_input_tiles", f"""
SELECT country AS area, t.zoom, t.x, t.y FROM boundaries b JOIN tiles t ON final AND {MEET.format(a='b', b='t')}
WHERE NOT (t.min_lon_e7 >= b.min_lon_e7 + 200000000 AND t.max_lon_e7 <= b.max_lon_e7 - 200000000 AND t.min_lat_e7 >= b.min_lat_e7 + 100000000 AND t.max_lat_e7 <= b.max_lat_e7 - 100000000)
 AND (t.zoom, t.x, t.y) IN (SELECT (zoom, x, y) FROM tile_counts WHERE (x + y) % 7 <> 0)""", keep=True)
def j11(s, d):
    """Files are the counted tiles (their node count as length), without some that are taken as absent."""
    b = T.boundaries(s, d).withColumnRenamed("country", "area")
    holes = b.select("area", *[(F.col(c) + (1 if c.startswith("min") else -1) * (200000000 if "lon" in c else 100000000)).alias(c) for c in G.BOX])
    files = T.tile_counts(T.nodes(s, d)).where("(x + y) % 7 <> 0").withColumnRenamed("n", "length")
    return spatial.input_tiles(b, T.tiles(s, d), holes, files)


GROWN = "grown AS (" + SQL["x6_expand_bbox"][SQL["x6_expand_bbox"].rindex("SELECT zoom, x, y,\n") :] + ")"


@query("c6_neighbours", f"""
SELECT a.country, a.zoom || '-' || a.x || '-' || a.y AS origin, b.zoom || '-' || b.x || '-' || b.y AS neighbour
FROM (SELECT s.country, g.* FROM shards s JOIN grown g USING (zoom, x, y)) a JOIN (SELECT s.country, t.* FROM shards s JOIN tiles t USING (zoom, x, y)) b
ON a.country = b.country AND {MEET.format(a='a', b='b')}""", SHARD_CTE, GROWN, keep=True)
def c6(s, d):
    shards = boxed_shards(s, d).withColumn("shard", X.tile_name("zoom", "x", "y"))
    return spatial.neighbours(shards, 5000.0)


@query("j14_missing_proof", """
SELECT country, zoom, x, y, min(node_id) AS node_id, count(*) AS nodes FROM (
 SELECT s.country, s.zoom, s.x, s.y, greatest(t.min_lon_e7, b.min_lon_e7) AS a, greatest(t.min_lat_e7, b.min_lat_e7) AS e, least(t.max_lon_e7, b.max_lon_e7) AS c, least(t.max_lat_e7, b.max_lat_e7) AS f
 FROM shards s JOIN tiles t USING (zoom, x, y) JOIN boundaries b ON b.country = s.country WHERE (x + y) % 3 = 0) m
JOIN nodes ON lon_e7 >= a AND lon_e7 < c AND lat_e7 >= e AND lat_e7 < f
WHERE node_id % 5 <> 0 AND node_id NOT IN (SELECT node_id FROM way_nodes JOIN ways USING (way_id) WHERE kind = 'LINE') GROUP BY ALL""", SHARD_CTE, keep=True)
def j14(s, d):
    """Missing: every shard with (x + y) divisible by 3. Ignored: every fifth node. Ways that are not ingested: lines."""
    missing = boxed_shards(s, d).where("(x + y) % 3 = 0")
    n = T.nodes(s, d)
    skipped = T.ways(s, d).where("kind = 'LINE'").select(F.explode("nodes").alias("node_id")).distinct()
    return spatial.prove_missing(missing, n, T.boundaries(s, d), n.where("node_id % 5 = 0").select("node_id"), skipped)


# ---------------------------------------------------------------- countries as polygons


OUT_CTE = f"out_shards AS (SELECT DISTINCT country, zoom, x, y FROM tiles t JOIN rects b ON t.final AND {MEET.format(a='t', b='b')})"
_CUT = "SELECT s.country, s.zoom, s.x, s.y, greatest(t.min_lon_e7, b.min_lon_e7) AS a, greatest(t.min_lat_e7, b.min_lat_e7) AS e, least(t.max_lon_e7, b.max_lon_e7) AS c, least(t.max_lat_e7, b.max_lat_e7) AS f FROM {} s JOIN tiles t USING (zoom, x, y) JOIN rects b ON b.country = s.country"


@query("j1_country_outlines", "SELECT * FROM out_shards", OUT_CTE, keep=True)
def j1_outlines(s, d):
    """Countries as polygons: L-shaped, in two parts, with a hole."""
    return spatial.country_shards(T.tiles(s, d), T.outlines(s, d))


@query("x7_loading_outlines", f"""
SELECT country, zoom, x, y, CAST(sum(2 * CAST(c - a AS HUGEINT) * (f - e)) AS VARCHAR) AS area2 FROM ({_CUT.format('out_shards')}) WHERE a < c AND e < f GROUP BY ALL""", OUT_CTE, keep=True)
def x7_outlines(s, d):
    """Area of the loading areas: outlines cut to shards, without their holes."""
    shards = spatial.country_shards(T.tiles(s, d), T.outlines(s, d)).join(T.tiles(s, d).drop("final"), TILE_KEY)
    cut = spatial.loading_areas(shards, T.outlines(s, d))
    holes = F.aggregate("holes", F.lit(0).cast("decimal(38,0)"), lambda a, h: (a + G.area2(h)).cast("decimal(38,0)"))
    return cut.groupBy("country", "zoom", "x", "y").agg(F.sum(G.area2(F.col("outer")) - holes).alias("a")).where("a > 0").select("country", "zoom", "x", "y", F.col("a").cast("decimal(38,0)").cast("string").alias("area2"))


@query("j9_fan_out_outlines", f"""
SELECT DISTINCT relation_id, b.country, t.zoom, t.x, t.y FROM rel r JOIN tiles t ON final AND {MEET.format(a='r', b='t')}
JOIN rects b ON {MEET.format(a='b', b='r')} JOIN out_shards o ON o.country = b.country AND o.zoom = t.zoom AND o.x = t.x AND o.y = t.y""", REL_CTE, OUT_CTE, keep=True)
def j9_outlines(s, d):
    return spatial.fan_out(relation_boxes(s, d), T.tiles(s, d), T.outlines(s, d))


@query("j11_input_outlines", """
SELECT DISTINCT country AS area, zoom, x, y FROM out_shards JOIN tile_counts USING (zoom, x, y)""", OUT_CTE, keep=True)
def j11_outlines(s, d):
    """Tiles to read for countries as polygons; tiles inside of a hole are not needed."""
    areas = T.outlines(s, d).withColumnRenamed("country", "area")
    none = areas.where("false").select("area", *G.BOX)
    return spatial.input_tiles(areas, T.tiles(s, d), none, T.tile_counts(T.nodes(s, d)).withColumnRenamed("n", "length"))


@query("j14_missing_outlines", f"""
SELECT country, zoom, x, y, min(node_id) AS node_id, count(*) AS nodes FROM ({_CUT.format('out_shards')} WHERE (s.x + s.y) % 3 = 0) JOIN nodes ON lon_e7 >= a AND lon_e7 < c AND lat_e7 >= e AND lat_e7 < f
WHERE node_id % 5 <> 0 GROUP BY ALL""", OUT_CTE, keep=True)
def j14_outlines(s, d):
    """Missing: every shard with (x + y) divisible by 3; nodes count inside of the polygons only."""
    missing = spatial.country_shards(T.tiles(s, d), T.outlines(s, d)).where("(x + y) % 3 = 0").join(T.tiles(s, d).drop("final"), TILE_KEY)
    n = T.nodes(s, d)
    return spatial.prove_missing(missing, n, T.outlines(s, d), n.where("node_id % 5 = 0").select("node_id"), n.where("false").select("node_id"))


@query("x9_point_in_outline", "SELECT node_id, country FROM nodes n JOIN rects b ON lon_e7 >= min_lon_e7 AND lon_e7 < max_lon_e7 AND lat_e7 >= min_lat_e7 AND lat_e7 < max_lat_e7")
def x9_outline(s, d):
    return spatial.locate(T.nodes(s, d), T.outlines(s, d)).select("node_id", "country")


@query("x12_covered_by_holes", """
SELECT t.zoom, t.x, t.y, country FROM tiles t JOIN boundaries b ON CAST(substr(country, 2) AS INTEGER) % 3 = 1
WHERE t.min_lon_e7 > b.min_lon_e7 + 540000000 AND t.max_lon_e7 < b.min_lon_e7 + 660000000 AND t.min_lat_e7 > b.min_lat_e7 + 100000000 AND t.max_lat_e7 < b.min_lat_e7 + 240000000""", keep=True)
def x12(s, d):
    """Tiles, of all levels, that a country's hole covers."""
    pairs = spatial.join_boxes(T.tiles(s, d).select("zoom", "x", "y", *G.BOX), T.outlines(s, d).where(F.size("holes") > 0))
    return pairs.where(G.holes_cover(F.col("b_holes"), G.box_columns("a_"))).select(*[F.col("a_" + c).alias(c) for c in TILE_KEY], F.col("b_country").alias("country"))
