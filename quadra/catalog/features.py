"""Queries over features, the routing graph, relations and published tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadra import tables as T
from quadra.catalog.tiles import MEET, REL_CTE, relation_boxes
from quadra.functions import geometry as G
from quadra.functions import tags as P
from quadra.functions.tiles import degrees_text
from quadra.operators import entities, relations, rings, spatial
from quadra.plans import build, raw, slicing

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, *ctes: str, keep: bool = False):
    """``keep``: derived tables that the query reads more than once are stored first."""

    def add(f):
        QUERIES[name] = T.keeping(f) if keep else f
        if sql:
            SQL[name] = T.with_prelude(sql, *ctes)
        return f

    return add


# ---------------------------------------------------------------- the derived features, in both languages


@T.kept
def features(s, d):
    """Areas, lines (ways before sectioning keep to themselves) and points."""
    w = T.ways(s, d).where("kind <> 'road'")
    return build.raw_features(w, tagged_points(s, d))


def tagged_points(s, d):
    return T.points(s, d).select("id", "lon_e7", "lat_e7", F.create_map(F.lit("amenity"), F.col("amenity")).alias("tags"))


def road_nodes(s, d):
    roads = T.ways(s, d).where("kind = 'road'").select("way_id")
    return T.way_nodes(s, d).join(roads, "way_id", "left_semi")


@T.kept
def road_sections(s, d):
    """Stored in one direction, without their reverses."""
    return build.sections_of(T.roads(s, d), T.lines_of)


def edges(s, d):
    return build.edges(road_sections(s, d))


@T.kept
def feature_members(s, d):
    """Members by feature id: areas by their million-fold way id, relations by themselves."""
    m = T.members(s, d)
    return m.withColumn("member_id", F.when(F.col("member_type") == "AREA", F.col("member_id") * 1_000_000).otherwise(F.col("member_id")))


WKT = "string_agg({} || ' ' || {}, ', ' ORDER BY seq)".format(T.sql_degrees("lon_e7"), T.sql_degrees("lat_e7"))
BOX_WKT = "'POLYGON ((' || {a} || ' ' || {b} || ', ' || {a} || ' ' || {d} || ', ' || {c} || ' ' || {d} || ', ' || {c} || ' ' || {b} || ', ' || {a} || ' ' || {b} || '))'".format(
    a=T.sql_degrees("min_lon_e7"), b=T.sql_degrees("min_lat_e7"), c=T.sql_degrees("max_lon_e7"), d=T.sql_degrees("max_lat_e7")
)
FEATURES = """features AS (
 SELECT kind AS item_type, way_id * 1000000 AS id, min_lon_e7, min_lat_e7, max_lon_e7, max_lat_e7, CASE WHEN kind = 'AREA' THEN 'landuse=forest' ELSE 'waterway=river' END AS tags FROM ways WHERE kind <> 'road'
 UNION ALL SELECT 'POINT', id * 1000000, lon_e7, lat_e7, lon_e7, lat_e7, 'amenity=' || amenity FROM points)"""
RINGS = "rings AS (SELECT way_id, seq, lon_e7, lat_e7 FROM way_nodes JOIN ways USING (way_id) WHERE kind = 'AREA' UNION ALL SELECT w.way_id, n + 1, p.lon_e7, p.lat_e7 FROM ways w JOIN way_nodes p ON p.way_id = w.way_id AND p.seq = 1 WHERE kind = 'AREA' AND first_node <> last_node)"
EDGES = (
    "roads AS (SELECT * FROM ways WHERE kind = 'road')",
    "rn AS (SELECT p.*, r.n FROM way_nodes p JOIN roads r USING (way_id))",
    "passes AS (SELECT node_id, count(*) AS c FROM rn GROUP BY 1)",
    "jn AS (SELECT rn.*, CASE WHEN c > 1 OR seq = 1 OR seq = n THEN 1 ELSE 0 END AS j FROM rn JOIN passes USING (node_id))",
    "sn AS (SELECT *, CAST(sum(j) OVER (PARTITION BY way_id ORDER BY seq) AS INTEGER) AS s FROM jn)",
    "parts AS (SELECT way_id, s AS section, seq, node_id, lon_e7, lat_e7 FROM sn WHERE seq < n UNION ALL SELECT way_id, s - 1, seq, node_id, lon_e7, lat_e7 FROM sn WHERE j = 1 AND seq > 1)",
    f"secs AS (SELECT way_id, section, arg_min(node_id, seq) AS start_node, arg_max(node_id, seq) AS end_node, {WKT} AS wkt, {WKT.replace('ORDER BY seq', 'ORDER BY seq DESC')} AS tkw, arg_min(lon_e7, seq) = arg_max(lon_e7, seq) AND arg_min(lat_e7, seq) = arg_max(lat_e7, seq) AND count(*) > 2 AS closed FROM parts GROUP BY ALL)",
    """edges AS (SELECT way_id * 1000000 + section AS id, s.*, wkt AS line, hw, oneway, roundabout FROM secs s JOIN roads USING (way_id)
 UNION ALL SELECT -(way_id * 1000000 + section), way_id, section, end_node, start_node, wkt, tkw, closed, tkw, hw, oneway, roundabout FROM secs s JOIN roads USING (way_id) WHERE NOT oneway)""",
)
WAY_TAGS = "'highway=' || hw || CASE WHEN roundabout THEN ';junction=roundabout' ELSE '' END || CASE WHEN oneway THEN ';oneway=yes' ELSE '' END"
PARENTS = "parents AS (SELECT member_type, member_id, string_agg(CAST(relation_id AS VARCHAR), ',' ORDER BY relation_id) AS relations FROM (SELECT DISTINCT relation_id, member_type, CASE WHEN member_type = 'AREA' THEN member_id * 1000000 ELSE member_id END AS member_id FROM members) GROUP BY ALL)"
ADJ = (
    "ins AS (SELECT end_node AS node_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS i, count(*) AS ni FROM edges GROUP BY 1)",
    "outs AS (SELECT start_node AS node_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS o, count(*) AS no FROM edges GROUP BY 1)",
)


def flat(df):
    """Arrays and maps as text, so that rows compare in any engine."""
    for name, kind in df.dtypes:
        if kind == "array<string>":
            df = df.withColumn(name, F.array_join(F.coalesce(F.col(name), F.array().cast("array<string>")), ","))
        elif kind.startswith("map<"):
            df = df.withColumn(name, P.tags_text(F.col(name)))
    return df


# ---------------------------------------------------------------- building


@query("c1_raw_features", "SELECT * FROM (" + "SELECT item_type, id, min_lon_e7, min_lat_e7, max_lon_e7, max_lat_e7, tags FROM features)", FEATURES)
def c1(s, d):
    return flat(features(s, d).drop("geom"))


@query("s6_read_raw", "SELECT way_id, kind FROM ways WHERE min_lon_e7 <= 360000000 AND max_lon_e7 >= -360000000 AND min_lat_e7 <= 400000000 AND max_lat_e7 >= 0 AND kind <> 'LINE'")
def s6(s, d):
    """Two inputs united, restricted to a box and a filter on ways."""
    w = T.ways(s, d)
    area = {c: F.lit(v) for c, v in zip(G.BOX, (-360000000, 0, 360000000, 400000000))}
    return build.read_raw(w.where("way_id % 2 = 0"), area, w.where("way_id % 2 = 1"), rule=~P.has_tag("waterway")).select("way_id", "kind")


_BOX = dict(zip(G.BOX, (-360000000, 0, 360000000, 400000000)))
#: Two inputs: the second has a second version of every third node (it has moved), of every fifth way (it is shorter) and of every tenth
#: customer's relation (it has one member left).
RAW = (
    "raw_nodes AS (SELECT node_id, CASE WHEN node_id % 3 = 0 THEN lon_e7 + 50000000 ELSE lon_e7 END AS lon_e7, lat_e7 FROM nodes)",
    "raw_ways AS (SELECT way_id, node_id FROM way_nodes JOIN ways USING (way_id) WHERE way_id % 5 <> 0 OR seq <= 2)",
    "raw_members AS (SELECT * FROM members WHERE NOT (relation_id % 10 = 0 AND member_type = 'AREA' AND seq <> 1))",
    "inside AS (SELECT node_id FROM raw_nodes WHERE {})",
    "kept_ways AS (SELECT DISTINCT way_id FROM raw_ways JOIN inside USING (node_id))",
    "kept_nodes AS (SELECT node_id FROM inside UNION SELECT node_id FROM raw_ways JOIN kept_ways USING (way_id))",
    "lower_relations AS (SELECT DISTINCT relation_id FROM raw_members JOIN kept_ways ON member_type = 'AREA' AND way_id = member_id)",
    "kept_relations AS (SELECT relation_id FROM lower_relations UNION SELECT m.relation_id FROM raw_members m JOIN lower_relations l ON member_type = 'RELATION' AND member_id = l.relation_id)",
)
_RAW_SQL = "SELECT 'node' AS kind, node_id AS id, lon_e7 AS value FROM kept_nodes JOIN raw_nodes USING (node_id) UNION ALL SELECT 'way', way_id, count(*) FROM raw_ways JOIN kept_ways USING (way_id) GROUP BY way_id UNION ALL SELECT 'relation', relation_id, count(*) FROM raw_members JOIN kept_relations USING (relation_id) GROUP BY relation_id"
_IN_BOX = "lon_e7 BETWEEN -360000000 AND 360000000 AND lat_e7 BETWEEN 0 AND 400000000"


def _completed(s, d, areas=None):
    n = T.nodes(s, d).select("node_id", F.lit(1).alias("version"), "lon_e7", "lat_e7")
    w = T.ways(s, d).select("way_id", F.lit(1).alias("version"), "nodes")
    m = T.members(s, d).select("relation_id", F.lit(1).alias("version"), "seq", F.when(F.col("member_type") == "AREA", "WAY").otherwise(F.col("member_type")).alias("member_type"), "member_id", "role")
    two = F.lit(2).alias("version")
    n2 = n.where("node_id % 3 = 0").select("node_id", two, (F.col("lon_e7") + 50000000).alias("lon_e7"), "lat_e7")
    w2 = w.where("way_id % 5 = 0").select("way_id", two, F.slice("nodes", 1, 2).alias("nodes"))
    m2 = m.where("relation_id % 10 = 0 and member_type = 'WAY' and seq = 1").withColumn("version", F.lit(2))
    got = raw.complete([n, n2], [w, w2, w.where("way_id % 2 = 0")], [m, m2], _BOX, areas)
    part = lambda kind, df, key, value: df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), value.cast("long").alias("value"))
    relations_of = got["members"].groupBy("relation_id").agg(F.count(F.lit(1)).alias("n"))
    return part("node", got["nodes"], "node_id", F.col("lon_e7")).unionByName(part("way", got["ways"], "way_id", F.size("nodes"))).unionByName(part("relation", relations_of, "relation_id", F.col("n")))


@query("s6_completed", _RAW_SQL, *[c.format(_IN_BOX) for c in RAW], keep=True)
def s6_completed(s, d):
    """Nodes, ways and relations from inputs with overlapping versions: whole ways, relations of what stays."""
    return _completed(s, d)


@query("s6_completed_outlines", _RAW_SQL, *[c.format(_IN_BOX + " AND EXISTS (SELECT 1 FROM rects b WHERE lon_e7 >= b.min_lon_e7 AND lon_e7 < b.max_lon_e7 AND lat_e7 >= b.min_lat_e7 AND lat_e7 < b.max_lat_e7)") for c in RAW], keep=True)
def s6_outlines(s, d):
    """The same inside of countries that are polygons."""
    return _completed(s, d, T.outlines(s, d))


@query("c3_sectioning", "SELECT id, way_id, section, start_node, end_node, 'LINESTRING (' || line || ')' AS geometry FROM edges", *EDGES, keep=True)
def c3(s, d):
    return edges(s, d).select("id", "way_id", "section", "start_node", "end_node", G.to_wkt(F.col("geom")).alias("geometry"))


_IN = "lon_e7 >= min_lon_e7 AND lon_e7 < max_lon_e7 AND lat_e7 >= min_lat_e7 AND lat_e7 < max_lat_e7"


@query("c2_slicing", """
SELECT way_id, piece, country, seq * 2 AS seq, lon_e7, lat_e7, false AS cut FROM num
UNION ALL SELECT way_id, piece - 1, pc, ps * 2 + 1, cx, cy, true FROM cuts
UNION ALL SELECT way_id, piece, country, seq * 2 - 1, cx, cy, true FROM cuts""",
    f"placed AS (SELECT p.way_id, seq, lon_e7, lat_e7, country, b.min_lon_e7 AS a, b.min_lat_e7 AS e, b.max_lon_e7 AS c, b.max_lat_e7 AS f FROM way_nodes p JOIN boundaries b ON {_IN})",
    "lagged AS (SELECT *, lag(country) OVER w AS pc, lag(seq) OVER w AS ps, lag(lon_e7) OVER w AS px, lag(lat_e7) OVER w AS py, lag(a) OVER w AS pa, lag(e) OVER w AS pe, lag(c) OVER w AS pcx, lag(f) OVER w AS pf FROM placed WINDOW w AS (PARTITION BY way_id ORDER BY seq))",
    "num AS (SELECT *, CAST(sum(CASE WHEN ps IS NULL OR seq <> ps + 1 OR country <> pc THEN 1 ELSE 0 END) OVER (PARTITION BY way_id ORDER BY seq) AS INTEGER) AS piece FROM lagged)",
    "xat AS (SELECT *, CASE WHEN lon_e7 >= pcx THEN pcx WHEN lon_e7 < pa THEN pa END AS xa, CASE WHEN lat_e7 >= pf THEN pf ELSE pe END AS ya FROM num WHERE seq = ps + 1 AND country <> pc)",
    "cuts AS (SELECT *, CASE WHEN xa IS NOT NULL THEN xa ELSE px + CAST(floor(CAST((lon_e7 - px) AS DOUBLE) * (ya - py) / (lat_e7 - py)) AS BIGINT) END AS cx, CASE WHEN xa IS NOT NULL THEN py + CAST(floor(CAST((lat_e7 - py) AS DOUBLE) * (xa - px) / (lon_e7 - px)) AS BIGINT) ELSE ya END AS cy FROM xat)")
def c2(s, d):
    return build.slice_at_borders(T.way_nodes(s, d), T.boundaries(s, d))


def _sql_side(of: str, name: str, at: str, axis: str, sign: str) -> str:
    """A step of the clipping: the list ``r`` of open outlines against one side of a box."""
    other = "y" if axis == "x" else "x"
    a, b = "r[i]", "r[CASE WHEN i < len(r) THEN i + 1 ELSE 1 END]"
    inside = lambda p: f"{sign} ({p}.{axis} - {at}) >= 0"
    along = f"CAST(round({a}.{other} + CAST({at} - {a}.{axis} AS DOUBLE) / CAST({b}.{axis} - {a}.{axis} AS DOUBLE) * ({b}.{other} - {a}.{other})) AS BIGINT)"
    cut = f"{{'x': {at if axis == 'x' else along}, 'y': {at if axis == 'y' else along}}}"
    none = "CAST([] AS STRUCT(x BIGINT, y BIGINT)[])"
    each = f"list_concat(CASE WHEN {inside(a)} THEN [{a}] ELSE {none} END, CASE WHEN ({inside(a)}) <> ({inside(b)}) THEN [{cut}] ELSE {none} END)"
    return f"{name} AS (SELECT id, country, a, e, c, f, flatten(list_transform(range(1, len(r) + 1), lambda i: {each})) AS r FROM {of})"


_SLICES = (
    "open AS (SELECT way_id, list({'x': lon_e7, 'y': lat_e7} ORDER BY seq)[:-2] AS r FROM rings GROUP BY 1)",
    f"k0 AS (SELECT w.way_id * 1000000 AS id, country, b.min_lon_e7 AS a, b.min_lat_e7 AS e, b.max_lon_e7 AS c, b.max_lat_e7 AS f, r FROM ways w JOIN open USING (way_id) JOIN boundaries b ON {MEET.format(a='w', b='b')} WHERE kind = 'AREA')",
    _sql_side("k0", "k1", "a", "x", "+"), _sql_side("k1", "k2", "c", "x", "-"), _sql_side("k2", "k3", "e", "y", "+"), _sql_side("k3", "k4", "f", "y", "-"),
    "k5 AS (SELECT id, country, list_filter(list_transform(range(1, len(r) + 1), lambda i: CASE WHEN r[i] <> r[CASE WHEN i > 1 THEN i - 1 ELSE len(r) END] THEN r[i] END), lambda p: p IS NOT NULL) AS r FROM k4)",
)


@query("c2_slice_polygons", "SELECT id, country, 'POLYGON ((' || string_agg({} || ' ' || {}, ', ' ORDER BY i) || '))' AS geometry FROM (SELECT id, country, i, (r || r[:1])[i].x AS x, (r || r[:1])[i].y AS y FROM (SELECT *, unnest(range(1, len(r) + 2)) AS i FROM k5 WHERE len(r) > 2)) GROUP BY id, country".format(T.sql_degrees("x"), T.sql_degrees("y")), RINGS, *_SLICES, keep=True)
def c2_polygons(s, d):
    a = features(s, d).where("item_type = 'AREA'")
    return build.slice_polygons(a, T.boundaries(s, d)).select("id", "country", G.to_wkt(F.col("geom"), "POLYGON").alias("geometry"))


#: The outlines' edges, which are upright or level: kind of country, upright, where, from, to (degrees in the country's box).
_BORDERS = """borders AS (SELECT country, upright, CASE WHEN upright THEN min_lon_e7 ELSE min_lat_e7 END + k * 10000000 AS k, CASE WHEN upright THEN min_lat_e7 ELSE min_lon_e7 END + lo * 10000000 AS lo,
  CASE WHEN upright THEN min_lat_e7 ELSE min_lon_e7 END + hi * 10000000 AS hi
 FROM boundaries JOIN (VALUES (0, true, 0, 0, 34), (0, true, 36, 17, 34), (0, true, 72, 0, 17), (0, false, 34, 0, 36), (0, false, 17, 36, 72), (0, false, 0, 0, 72),
  (1, true, 0, 0, 34), (1, true, 24, 0, 34), (1, true, 48, 0, 34), (1, true, 72, 0, 34), (1, true, 54, 10, 24), (1, true, 66, 10, 24),
  (1, false, 0, 0, 24), (1, false, 34, 0, 24), (1, false, 0, 48, 72), (1, false, 34, 48, 72), (1, false, 10, 54, 66), (1, false, 24, 54, 66),
  (2, true, 0, 0, 34), (2, true, 72, 0, 34), (2, false, 0, 0, 72), (2, false, 34, 0, 72)) v(i, upright, k, lo, hi) ON CAST(substr(country, 2) AS INTEGER) % 3 = i)"""
_fdiv = lambda n, d: f"(({n}) // ({d}) - CASE WHEN ({n}) % ({d}) <> 0 AND (({n}) < 0) <> (({d}) < 0) THEN 1 ELSE 0 END)"
_PIECES = (
    "wn AS (SELECT way_nodes.* FROM way_nodes SEMI JOIN ways USING (way_id))",
    _BORDERS,
    "held AS (SELECT DISTINCT p.way_id, seq, lon_e7, lat_e7, country FROM wn p JOIN rects b ON lon_e7 >= min_lon_e7 AND lon_e7 < max_lon_e7 AND lat_e7 >= min_lat_e7 AND lat_e7 < max_lat_e7)",
    "steps AS (SELECT * FROM (SELECT way_id, seq, CAST(lon_e7 AS HUGEINT) AS x1, CAST(lat_e7 AS HUGEINT) AS y1, CAST(lead(lon_e7) OVER w AS HUGEINT) AS x2, CAST(lead(lat_e7) OVER w AS HUGEINT) AS y2 FROM wn WINDOW w AS (PARTITION BY way_id ORDER BY seq)) WHERE x2 IS NOT NULL)",
    # a step along (u, v) crosses the line u = k; points lie a little to the east and, by less, to the north
    "turned AS (SELECT way_id, seq, true AS upright, x1 AS u1, y1 AS v1, x2 AS u2, y2 AS v2 FROM steps UNION ALL SELECT way_id, seq, false, y1, x1, y2, x2 FROM steps)",
    "hits AS (SELECT t.*, country, k, sign(u2 - u1) * (v1 * (u2 - u1) + (k - u1) * (v2 - v1) - lo * (u2 - u1)) AS above_lo, sign(u2 - u1) * (v1 * (u2 - u1) + (k - u1) * (v2 - v1) - hi * (u2 - u1)) AS above_hi, (v2 - v1) * sign(u2 - u1) <= 0 OR NOT upright AS tie FROM turned t JOIN borders USING (upright) WHERE (u1 >= k) <> (u2 >= k))",
    "cr AS (SELECT way_id, seq, country, (abs(k - u1) * 4611686018427387904) // abs(u2 - u1) AS pos, any_value(CASE WHEN upright THEN k ELSE c END) AS lon_e7, any_value(CASE WHEN upright THEN c ELSE k END) AS lat_e7 FROM (SELECT *, v1 + " + _fdiv("(k - u1) * (v2 - v1)", "u2 - u1") + " AS c FROM hits WHERE (above_lo > 0 OR above_lo = 0 AND tie) AND NOT (above_hi > 0 OR above_hi = 0 AND tie)) GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1)",
    "ev AS (SELECT cr.way_id, cr.country, cr.seq, pos, cr.lon_e7, cr.lat_e7, (h.seq IS NOT NULL) = (row_number() OVER (PARTITION BY cr.way_id, cr.seq, cr.country ORDER BY pos) % 2 = 0) AS start FROM cr LEFT JOIN held h ON h.way_id = cr.way_id AND h.seq = cr.seq AND h.country = cr.country UNION ALL SELECT way_id, country, seq, -1, lon_e7, lat_e7, seq = 1 FROM held)",
    "runs AS (SELECT *, sum(CASE WHEN start THEN 1 ELSE 0 END) OVER (PARTITION BY way_id, country ORDER BY seq, pos) AS run FROM ev)",
    "shown AS (SELECT *, lag(lon_e7) OVER w IS NOT DISTINCT FROM lon_e7 AND lag(lat_e7) OVER w IS NOT DISTINCT FROM lat_e7 AS again FROM runs WINDOW w AS (PARTITION BY way_id, country, run ORDER BY seq, pos))",
    "pieces AS (SELECT way_id, country, run, min((seq, pos)) AS began, string_agg({} || ' ' || {}, ', ' ORDER BY seq, pos) FILTER (NOT again) AS line, count(*) FILTER (NOT again) AS n FROM shown GROUP BY ALL)".format(T.sql_degrees("lon_e7"), T.sql_degrees("lat_e7")),
)


@query("c2_slicing_outlines", "SELECT way_id * 1000000 + piece * 1000 AS id, country, 'LINESTRING (' || line || ')' AS geometry, 'iso_country_code=' || country AS code FROM (SELECT *, row_number() OVER (PARTITION BY way_id ORDER BY began, country) AS piece FROM pieces WHERE n > 1)", *_PIECES, keep=True)
def c2_outlines(s, d):
    """Ways of all kinds cut at countries that are polygons: L-shaped, in two parts, with a hole."""
    made = slicing.country_lines(T.ways(s, d), T.way_nodes(s, d).join(T.ways(s, d).select("way_id"), "way_id", "left_semi"), T.outlines(s, d))
    code = F.concat(F.lit("iso_country_code="), F.element_at("tags", F.lit("iso_country_code")))
    return made.select("id", "country", G.to_wkt(F.col("geom")).alias("geometry"), code.alias("code"))


@query("c2_slice_polygons_outlines", "SELECT way_id * 1000000 AS \"of\", country, 'iso_country_code=' || country || ';landuse=forest' AS tags, CAST(sum(2 * (CAST(least(w.max_lon_e7, b.max_lon_e7) AS HUGEINT) - greatest(w.min_lon_e7, b.min_lon_e7)) * (least(w.max_lat_e7, b.max_lat_e7) - greatest(w.min_lat_e7, b.min_lat_e7))) AS VARCHAR) AS area2 FROM ways w JOIN rects b ON w.min_lon_e7 < b.max_lon_e7 AND b.min_lon_e7 < w.max_lon_e7 AND w.min_lat_e7 < b.max_lat_e7 AND b.min_lat_e7 < w.max_lat_e7 WHERE kind = 'AREA' AND w.min_lon_e7 < w.max_lon_e7 AND w.min_lat_e7 < w.max_lat_e7 GROUP BY ALL", keep=True)
def c2_polygons_outlines(s, d):
    """The boxes of all areas cut at countries that are polygons; the pieces' areas add up to what rectangles have in common."""
    a = features(s, d).where("item_type = 'AREA' and min_lon_e7 < max_lon_e7 and min_lat_e7 < max_lat_e7")
    boxes = a.select("id", G.box_ring(G.box_columns()).alias("outer"), F.array().cast(f"array<{G.POINTS}>").alias("holes"), "tags")
    made = slicing.country_areas(boxes, T.outlines(s, d)).withColumn("parts", F.array(F.struct("outer", "holes")))
    sums = made.groupBy("of", "country", P.tags_text(F.col("tags")).alias("tags")).agg(F.sum(rings.parts_area2(F.col("parts"))).alias("a"))
    return sums.select("of", "country", "tags", F.col("a").cast("decimal(38,0)").cast("string").alias("area2"))


@query("c4_subset", """
SELECT 'feature' AS kind, item_type AS a, id AS b FROM features WHERE tags = 'landuse=forest' AND id % 3000000 = 0
UNION ALL SELECT 'node', '', node_id FROM (SELECT DISTINCT unnest([first_node, last_node]) AS node_id FROM ways WHERE kind = 'AREA' AND way_id % 3 = 0)
UNION ALL SELECT 'member', role, member_id * 1000000 FROM members WHERE member_type = 'AREA' AND member_id % 3 = 0""", FEATURES, keep=True)
def c4(s, d):
    return _subset(s, d, "SOFT")


def _subset(s, d, cut):
    w = T.ways(s, d)
    nodes_of = w.where("kind = 'AREA'").select((F.col("way_id") * 1_000_000).alias("id"), F.posexplode("nodes").alias("pos", "node_id"), (F.size("nodes") - 1).alias("n")).select("id", "node_id", (F.col("pos") == 0).alias("first"), (F.col("pos") == F.col("n")).alias("last"))
    got = build.subset(features(s, d), nodes_of, feature_members(s, d), P.tag_filter("landuse->forest") & (F.col("id") % 3_000_000 == 0), cut)
    f = got["features"].select(F.lit("feature").alias("kind"), F.col("item_type").alias("a"), F.col("id").alias("b"))
    return f.unionByName(got["nodes"].select(F.lit("node").alias("kind"), F.lit("").alias("a"), F.col("node_id").alias("b"))).unionByName(got["members"].select(F.lit("member").alias("kind"), F.col("role").alias("a"), F.col("member_id").alias("b")))


@query("c4_silk_subset", """
SELECT 'feature' AS kind, item_type AS a, id AS b FROM features WHERE tags = 'landuse=forest' AND id % 3000000 = 0
UNION ALL SELECT 'node', '', node_id FROM (SELECT DISTINCT node_id FROM way_nodes JOIN ways USING (way_id) WHERE kind = 'AREA' AND way_id % 3 = 0)
UNION ALL SELECT 'member', role, member_id * 1000000 FROM members WHERE member_type = 'AREA' AND member_id % 3 = 0""", FEATURES, keep=True)
def c4_silk(s, d):
    """All nodes of each way that is kept, not its ends alone."""
    return _subset(s, d, "SILK")


@query("c14_world", "SELECT '0-0-0' AS shard, 'WORLD' AS country, item_type, count(*) AS n FROM features GROUP BY ALL", FEATURES)
def c14(s, d):
    return features(s, d).groupBy(F.lit("0-0-0").alias("shard"), F.lit("WORLD").alias("country"), "item_type").agg(F.count(F.lit(1)).alias("n"))


@query("u3_without_copies", "SELECT item_type, id, CASE WHEN id % 2000000 = 0 THEN 'A' ELSE 'B' END AS country FROM features", FEATURES)
def u3(s, d):
    """Country B holds all features, country A the even ones again."""
    f = features(s, d).select("item_type", "id")
    both = f.withColumn("country", F.lit("B")).unionByName(f.where("id % 2000000 = 0").withColumn("country", F.lit("A")))
    return build.without_copies(both)


@query("w4_section_numbers", "SELECT way_id, max(section) AS sections FROM parts GROUP BY 1", *EDGES, keep=True)
def w4(s, d):
    return build.sections(road_nodes(s, d)).groupBy("way_id").agg(F.max("section").alias("sections"))


# ---------------------------------------------------------------- published tables


@query("p1_areas", f"""
SELECT CAST(way_id * 1000000 AS VARCHAR) AS identifier, 'POLYGON ((' || line || '))' AS geometry, {BOX_WKT} AS bounds, 'landuse=forest' AS tags, coalesce(relations, '') AS relations
FROM ways JOIN (SELECT way_id, {WKT} AS line FROM rings GROUP BY 1) USING (way_id) LEFT JOIN parents ON member_type = 'AREA' AND member_id = way_id * 1000000 WHERE kind = 'AREA'""", RINGS, PARENTS, keep=True)
def p1(s, d):
    return flat(entities.areas_df(features(s, d), feature_members(s, d)))


@query("p2_edges", f"""
SELECT CAST(e.id AS VARCHAR) AS identifier, 'LINESTRING (' || line || ')' AS geometry, CAST(start_node AS VARCHAR) AS start, CAST(end_node AS VARCHAR) AS "end", coalesce(i, '') AS inEdges, coalesce(o, '') AS outEdges,
 e.id IN (SELECT -id FROM edges) AS hasReverseEdge, closed AS isClosed, {WAY_TAGS} AS tags, '' AS relations
FROM edges e LEFT JOIN ins ON ins.node_id = start_node LEFT JOIN outs ON outs.node_id = end_node""", *EDGES, *ADJ, keep=True)
def p2(s, d):
    return flat(entities.edges_df(edges(s, d), feature_members(s, d)))


@query("p3_lines", f"""
SELECT CAST(way_id * 1000000 AS VARCHAR) AS identifier, 'LINESTRING (' || line || ')' AS geometry, {BOX_WKT} AS bounds, n > 2 AND first_node = last_node AS isClosed, 'waterway=river' AS tags, '' AS relations
FROM ways JOIN (SELECT way_id, {WKT} AS line FROM way_nodes GROUP BY 1) USING (way_id) WHERE kind = 'LINE'""")
def p3(s, d):
    return flat(entities.lines_df(features(s, d), feature_members(s, d)))


@query("p4_nodes", f"""
SELECT CAST(n.node_id AS VARCHAR) AS identifier, 'POINT (' || {T.sql_degrees('lon_e7')} || ' ' || {T.sql_degrees('lat_e7')} || ')' AS location, coalesce(i, '') AS inEdges, coalesce(o, '') AS outEdges,
 'ways=' || ways AS tags, '' AS relations FROM nodes n LEFT JOIN ins USING (node_id) LEFT JOIN outs ON outs.node_id = n.node_id WHERE i IS NOT NULL OR o IS NOT NULL""", *EDGES, *ADJ, keep=True)
def p4(s, d):
    n = T.nodes(s, d).withColumn("tags", F.create_map(F.lit("ways"), F.col("ways").cast("string")))
    return flat(entities.nodes_df(n, edges(s, d), feature_members(s, d)))


@query("p5_points", f"SELECT CAST(id * 1000000 AS VARCHAR) AS identifier, 'POINT (' || {T.sql_degrees('lon_e7')} || ' ' || {T.sql_degrees('lat_e7')} || ')' AS location, 'amenity=' || amenity AS tags, '' AS relations FROM points")
def p5(s, d):
    return flat(entities.points_df(features(s, d), feature_members(s, d)))


@query("p6_relations", f"""
SELECT CAST(relation_id AS VARCHAR) AS identifier, {BOX_WKT} AS geometry, ids AS memberIds, types AS memberTypes, roles AS memberRoles, 'type=multipolygon' AS tags, coalesce(relations, '') AS relations FROM (
 SELECT m.relation_id, min(min_lon_e7) AS min_lon_e7, min(min_lat_e7) AS min_lat_e7, max(max_lon_e7) AS max_lon_e7, max(max_lat_e7) AS max_lat_e7,
  string_agg(CAST(mid AS VARCHAR), ',' ORDER BY member_type, mid, role) AS ids, string_agg(member_type, ',' ORDER BY member_type, mid, role) AS types, string_agg(role, ',' ORDER BY member_type, mid, role) AS roles
 FROM (SELECT *, CASE WHEN member_type = 'AREA' THEN member_id * 1000000 ELSE member_id END AS mid FROM members) m LEFT JOIN ways w ON member_type = 'AREA' AND w.way_id = m.member_id GROUP BY 1) r
LEFT JOIN parents p ON p.member_type = 'RELATION' AND p.member_id = r.relation_id""", PARENTS, keep=True)
def p6(s, d):
    shapes = features(s, d).select(F.col("item_type").alias("member_type"), F.col("id").alias("member_id"), *G.BOX)
    return flat(entities.relations_df(feature_members(s, d), shapes))


QUERIES["w2_sorted_members"], SQL["w2_sorted_members"] = QUERIES["p6_relations"], SQL["p6_relations"]


@query("p7_item_types", "SELECT id, CASE id % 6 WHEN 0 THEN 'NODE' WHEN 1 THEN 'EDGE' WHEN 2 THEN 'AREA' WHEN 3 THEN 'LINE' WHEN 4 THEN 'POINT' ELSE 'RELATION' END AS item_type FROM points")
def p7(s, d):
    return T.points(s, d).select("id", P.item_type_name((F.col("id") % 6).cast("int")).alias("item_type"))


@query("a12_adjacency", "SELECT coalesce(ins.node_id, outs.node_id) AS node_id, coalesce(i, '') AS in_edges, coalesce(o, '') AS out_edges, CAST(coalesce(ni, 0) + coalesce(no, 0) AS INTEGER) AS valence FROM ins FULL JOIN outs USING (node_id)", *EDGES, *ADJ, keep=True)
def a12(s, d):
    return flat(entities.adjacency(edges(s, d)))


@query("j20_reverse", "SELECT id, id IN (SELECT -id FROM edges) AS has_reverse FROM edges", *EDGES, keep=True)
def j20(s, d):
    return entities.with_reverse(edges(s, d)).select("id", "has_reverse")


# ---------------------------------------------------------------- filters


@query("p8_tag_filter", "SELECT way_id FROM ways WHERE kind = 'road' AND ((hw = 'primary' AND oneway) OR (roundabout AND NOT oneway))")
def p8(s, d):
    return T.ways(s, d).where(P.tag_filter("highway->primary&oneway->yes|junction->*&highway->*&oneway->!")).select("way_id")


NAMED = [P.NamedFilter("forests", ("AREA",), "landuse->forest"), P.NamedFilter("water", ("LINE", "AREA"), "waterway->*"), P.NamedFilter("all")]


@query("p9_named_filter", "SELECT item_type, id FROM features WHERE item_type IN ('LINE', 'AREA') AND tags LIKE 'waterway=%'", FEATURES)
def p9(s, d):
    return features(s, d).where(NAMED[1].column()).select("item_type", "id")


@query("k9_filtered_outputs", """
SELECT 'all' AS filter, item_type, count(*) AS n FROM features GROUP BY ALL UNION ALL SELECT 'forests', item_type, count(*) FROM features WHERE item_type = 'AREA' GROUP BY ALL
UNION ALL SELECT 'water', item_type, count(*) FROM features WHERE item_type = 'LINE' GROUP BY ALL""", FEATURES)
def k9(s, d):
    return build.filtered_outputs(features(s, d), NAMED).groupBy("filter", "item_type").agg(F.count(F.lit(1)).alias("n"))


@query("p21_put_tag", "SELECT way_id, CASE WHEN kind = 'road' THEN replace(" + WAY_TAGS + ", 'highway=' || hw, 'highway=changed') WHEN kind = 'AREA' THEN 'highway=changed;landuse=forest' ELSE 'highway=changed;waterway=river' END AS tags FROM ways")
def p21(s, d):
    return flat(T.ways(s, d).select("way_id", P.put_tag(F.col("tags"), "highway", F.lit("changed")).alias("tags")))


# ---------------------------------------------------------------- geometry


@query("x8_area", "SELECT id, CAST(abs(sum(a)) AS VARCHAR) AS area2 FROM (SELECT way_id * 1000000 AS id, CAST(lon_e7 AS HUGEINT) * lead(lat_e7) OVER w - CAST(lead(lon_e7) OVER w AS HUGEINT) * lat_e7 AS a FROM rings WINDOW w AS (PARTITION BY way_id ORDER BY seq)) GROUP BY 1", RINGS)
def x8(s, d):
    return features(s, d).where("item_type = 'AREA'").select("id", G.area2(F.col("geom")).cast("string").alias("area2"))


@query("x9_point_in_box", f"SELECT id, country FROM points JOIN boundaries ON {_IN}")
def x9(s, d):
    """Ray cast against the countries' outlines; the cells only bring candidates together."""
    p = T.points(s, d).select("id", "lon_e7", "lat_e7", *[F.col("lon_e7" if "lon" in c else "lat_e7").alias(c) for c in G.BOX])
    pairs = spatial.join_boxes(p, T.boundaries(s, d))
    pt = lambda a, b: F.struct(F.col("b_" + a).alias("lon_e7"), F.col("b_" + b).alias("lat_e7"))
    ring = F.array(pt("min_lon_e7", "min_lat_e7"), pt("min_lon_e7", "max_lat_e7"), pt("max_lon_e7", "max_lat_e7"), pt("max_lon_e7", "min_lat_e7"), pt("min_lon_e7", "min_lat_e7"))
    return pairs.where(G.point_in_ring(F.col("a_lon_e7"), F.col("a_lat_e7"), ring)).select(F.col("a_id").alias("id"), F.col("b_country").alias("country"))


@query("x10_line_meets_tile", """
SELECT DISTINCT a.way_id, zoom, x, y FROM seg a JOIN tiles t ON final AND least(x1, x2) <= max_lon_e7 AND greatest(x1, x2) >= min_lon_e7 AND least(y1, y2) <= max_lat_e7 AND greatest(y1, y2) >= min_lat_e7
WHERE least(sign(dx * (min_lat_e7 - y1) - dy * (min_lon_e7 - x1)), sign(dx * (max_lat_e7 - y1) - dy * (min_lon_e7 - x1)), sign(dx * (min_lat_e7 - y1) - dy * (max_lon_e7 - x1)), sign(dx * (max_lat_e7 - y1) - dy * (max_lon_e7 - x1))) <= 0
 AND greatest(sign(dx * (min_lat_e7 - y1) - dy * (min_lon_e7 - x1)), sign(dx * (max_lat_e7 - y1) - dy * (min_lon_e7 - x1)), sign(dx * (min_lat_e7 - y1) - dy * (max_lon_e7 - x1)), sign(dx * (max_lat_e7 - y1) - dy * (max_lon_e7 - x1))) >= 0""",
    "seg AS (SELECT way_id, lon_e7 AS x1, lat_e7 AS y1, nx AS x2, ny AS y2, CAST(nx - lon_e7 AS HUGEINT) AS dx, CAST(ny - lat_e7 AS HUGEINT) AS dy FROM (SELECT *, lead(lon_e7) OVER w AS nx, lead(lat_e7) OVER w AS ny FROM way_nodes JOIN ways USING (way_id) WHERE kind = 'LINE' WINDOW w AS (PARTITION BY way_id ORDER BY seq)) WHERE nx IS NOT NULL)")
def x10(s, d):
    w = T.ways(s, d).where("kind = 'LINE'").select("way_id", "geom", *G.BOX)
    pairs = spatial.join_boxes(w, T.tiles(s, d).where("final"))
    return pairs.where(G.polyline_meets_box(F.col("a_geom"), G.box_columns("b_"))).select(F.col("a_way_id").alias("way_id"), *[F.col("b_" + c).alias(c) for c in ("zoom", "x", "y")])


@query("x11_rings", "SELECT way_id, seq - 1 AS pos, lon_e7, lat_e7 FROM rings", RINGS)
def x11(s, d):
    return T.ways(s, d).where("kind = 'AREA'").select("way_id", F.posexplode("geom").alias("pos", "p")).select("way_id", F.col("pos").cast("long").alias("pos"), "p.lon_e7", "p.lat_e7")


@query("x13_bounds", f"SELECT way_id, {BOX_WKT} AS bounds, kind = 'AREA' OR (n > 2 AND first_node = last_node) AS closed FROM ways")
def x13(s, d):
    return T.ways(s, d).select("way_id", G.box_wkt(*[F.col(c) for c in G.BOX]).alias("bounds"), G.is_closed(F.col("geom")).alias("closed"))


@query("x16_feature_ids", "SELECT way_id, way_id * 1000000 + 2 * 1000 + 3 AS id FROM ways")
def x16(s, d):
    return T.ways(s, d).select("way_id", G.feature_id("way_id", 2, 3).alias("id"))


# ---------------------------------------------------------------- relations


@query("a1_member_lines", "SELECT relation_id, role, member_id * 1000000 AS member_id FROM members WHERE member_type = 'AREA'", keep=True)
def a1(s, d):
    return relations.member_lines(feature_members(s, d), features(s, d)).select("relation_id", "role", "member_id")


@query("a2_merged_lines", f"SELECT relation_id, role, count(*) AS lines FROM (SELECT DISTINCT relation_id, role, line FROM members JOIN (SELECT way_id, {WKT} AS line FROM rings GROUP BY 1) ON way_id = member_id WHERE member_type = 'AREA') GROUP BY ALL", RINGS, keep=True)
def a2(s, d):
    m = relations.merge_lines(relations.member_lines(feature_members(s, d), features(s, d)))
    return m.select("relation_id", "role", F.size("lines").cast("long").alias("lines"))


#: Each area's outline is closed, so that a ring is a different line of a relation's role. A hole goes to the smallest outer ring that
#: holds more than half of its corners, by counting edges to the east of each.
RING_COUNTS = """rel_rings AS (SELECT relation_id, role, line, min(way_id) AS ring FROM (SELECT relation_id, role, line, way_id FROM members JOIN (SELECT way_id, {} AS line FROM rings GROUP BY 1) ON way_id = member_id WHERE member_type = 'AREA') GROUP BY ALL),
corners AS (SELECT relation_id, role, ring, seq, CAST(lon_e7 AS HUGEINT) AS x, CAST(lat_e7 AS HUGEINT) AS y, CAST(lead(lon_e7) OVER w AS HUGEINT) AS x2, CAST(lead(lat_e7) OVER w AS HUGEINT) AS y2
 FROM rel_rings JOIN rings ON way_id = ring WINDOW w AS (PARTITION BY relation_id, role, ring ORDER BY seq)),
ring_sides AS (SELECT * FROM corners WHERE x2 IS NOT NULL),
ring_areas AS (SELECT relation_id, role, ring, abs(sum(x * y2 - x2 * y)) AS area2, count(*) AS n FROM ring_sides GROUP BY ALL),
held AS (SELECT relation_id, hole, shell, count(*) AS inside FROM (SELECT h.relation_id, h.ring AS hole, h.seq, o.ring AS shell
  FROM ring_sides h JOIN ring_sides o ON o.relation_id = h.relation_id AND h.role = 'inner' AND o.role = 'outer'
  WHERE (o.y > h.y) <> (o.y2 > h.y) AND sign(o.y2 - o.y) * ((o.x2 - o.x) * (h.y - o.y) - (o.y2 - o.y) * (h.x - o.x)) > 0 GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY ALL),
owners AS (SELECT relation_id, hole, arg_min(shell, area2) AS shell FROM (SELECT held.*, a.area2 FROM held JOIN ring_areas a ON a.relation_id = held.relation_id AND a.role = 'outer' AND a.ring = shell
  JOIN ring_areas b ON b.relation_id = held.relation_id AND b.role = 'inner' AND b.ring = hole WHERE 2 * inside > b.n) GROUP BY ALL),
shapes AS (SELECT a.relation_id, count(*) FILTER (role = 'outer') AS outer_rings, count(shell) AS holes, CAST(sum(CASE WHEN role = 'outer' THEN area2 WHEN shell IS NOT NULL THEN -area2 ELSE 0 END) AS VARCHAR) AS area2
  FROM ring_areas a LEFT JOIN owners o ON a.role = 'inner' AND o.relation_id = a.relation_id AND o.hole = a.ring GROUP BY 1 HAVING count(*) FILTER (role = 'outer') > 0)""".replace("{}", WKT)


def ring_numbers(parts):
    """Columns outer_rings, holes and area2 of multipolygons."""
    count = lambda c: c.cast("long")
    return {"outer_rings": count(F.size(parts)), "holes": count(F.aggregate(parts, F.lit(0), lambda a, p: a + F.size(p["holes"]))), "area2": rings.parts_area2(parts).cast("decimal(38,0)").cast("string")}


@query("a3_polygons", "SELECT relation_id, outer_rings, holes, area2 FROM shapes", RINGS, RING_COUNTS, keep=True)
def a3(s, d):
    """Outer rings, holes that one of them holds, and the area that is left."""
    p = relations.polygons(relations.member_lines(feature_members(s, d), features(s, d)))
    return p.withColumns(ring_numbers(F.col("parts"))).drop("parts")


@query("a4_relations_of_shards", f"""
SELECT country, zoom, x, y, string_agg(CAST(relation_id AS VARCHAR), ',' ORDER BY relation_id) AS relations FROM (
 SELECT relation_id, b.country, t.zoom, t.x, t.y FROM rel r JOIN tiles t ON final AND {MEET.format(a='r', b='t')} JOIN boundaries b ON {MEET.format(a='b', b='t')} AND {MEET.format(a='b', b='r')}) GROUP BY ALL""", REL_CTE, keep=True)
def a4(s, d):
    pairs = spatial.fan_out(relation_boxes(s, d), T.tiles(s, d), T.boundaries(s, d))
    return relations.relations_of_shards(pairs).withColumn("relations", F.array_join("relations", ","))


@query("j3_augment", "SELECT ring * 1000000 AS id, 'AREA' AS item_type, 1 AS outer_rings, 0 AS holes, CAST(abs(sum(x * y2 - x2 * y)) AS VARCHAR) AS area2 FROM (SELECT way_id AS ring, CAST(lon_e7 AS HUGEINT) AS x, CAST(lat_e7 AS HUGEINT) AS y, CAST(lead(lon_e7) OVER w AS HUGEINT) AS x2, CAST(lead(lat_e7) OVER w AS HUGEINT) AS y2 FROM rings WINDOW w AS (PARTITION BY way_id ORDER BY seq)) WHERE x2 IS NOT NULL GROUP BY ring UNION ALL SELECT relation_id, 'RELATION', outer_rings, holes, area2 FROM shapes", RINGS, RING_COUNTS, keep=True)
def j3(s, d):
    """Areas keep their shape; relations without a shape of their own get the assembled one, all rings of it."""
    m, f = feature_members(s, d), features(s, d).where("item_type = 'AREA'")
    bare = m.where("member_type = 'AREA'").select(F.lit("RELATION").alias("item_type"), F.col("relation_id").alias("id"), F.lit(None).cast(G.POINTS).alias("geom")).distinct()
    all_of = relations.augment(f.select("item_type", "id", "geom").unionByName(bare), relations.polygons(relations.member_lines(m, f)))
    own = F.array(F.struct(F.col("geom").alias("outer"), F.array().cast(f"array<{G.POINTS}>").alias("holes")))
    parts = F.coalesce("parts", F.when(F.col("geom").isNotNull(), own))
    return all_of.withColumn("parts", parts).where("parts is not null").withColumns(ring_numbers(F.col("parts"))).select("id", "item_type", "outer_rings", "holes", "area2")


@query("c5_augmented_shards", f"""
SELECT b.country, t.zoom, t.x, t.y, r.relation_id, outer_rings, holes, area2 FROM outer_box r JOIN tiles t ON final AND {MEET.format(a='r', b='t')}
JOIN boundaries b ON {MEET.format(a='b', b='t')} AND {MEET.format(a='b', b='r')} JOIN shapes USING (relation_id)""", RINGS, RING_COUNTS,
    "outer_box AS (SELECT relation_id, min(min_lon_e7) AS min_lon_e7, min(min_lat_e7) AS min_lat_e7, max(max_lon_e7) AS max_lon_e7, max(max_lat_e7) AS max_lat_e7 FROM members JOIN ways ON member_type = 'AREA' AND role = 'outer' AND way_id = member_id GROUP BY 1)", keep=True)
def c5(s, d):
    out = relations.augmented_by_shard(feature_members(s, d), features(s, d), T.tiles(s, d), T.boundaries(s, d))
    return out.withColumns(ring_numbers(F.col("parts"))).drop("parts")


@query("j15_leaf_members", """
SELECT relation_id, member_type, member_id FROM members WHERE member_type = 'AREA'
UNION SELECT a.relation_id, b.member_type, b.member_id FROM members a JOIN members b ON a.member_type = 'RELATION' AND b.relation_id = a.member_id""", keep=True)
def j15(s, d):
    return relations.expand_members(T.members(s, d))
