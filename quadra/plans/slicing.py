"""Cutting ways at the borders of countries that are polygons.

Segments meet border edges in the tiles of the countries' cover, so that a segment is tested against the few edges near it. All
tests are exact, with the same rule as point location: points count as moved a little to the east and, by much less, to the north,
so that a segment crosses an edge or does not, and the number of crossings between two points always agrees with where the points
lie. Crossings are ordered along their segment by their parameter, in units of 2^-62, and several at one parameter count by whether
their number is odd: a way that touches a corner or steps over a line between two parts of one country is not cut there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.functions.geometry import POINTS, bounds, feature_id
from quadra.functions.tiles import E7, tile_x, tile_y
from quadra.operators.cover import EDGE, build_cover, cross, levels_of, locate_in, side
from quadra.operators.rings import chain, multipolygons, nested
from quadra.session import cut, stored

#: Tiles of a segment are found in floating point, with so much room (1e-7 degree); the exact test follows.
ROOM = 50
SEGMENT = ("x1", "y1", "x2", "y2")
#: The coarsest tiles in which segments meet border edges.
FINE = 8


def segments(way_nodes: DataFrame) -> DataFrame:
    """(way_id, seq, x1, y1, x2, y2): a row for each step of a way, by the number of its first node."""
    way = W.partitionBy("way_id").orderBy("seq")
    steps = way_nodes.select("way_id", "seq", F.col("lon_e7").alias("x1"), F.col("lat_e7").alias("y1"), F.lead("lon_e7").over(way).alias("x2"), F.lead("lat_e7").over(way).alias("y2"))
    return steps.where("x2 is not null and (x1 <> x2 or y1 <> y2)")


def _tiles_of_segments(steps: DataFrame, levels: Column) -> DataFrame:
    """A row for each tile (``t``) that a segment comes near, at each of the levels: column by column, the rows between the
    latitudes at which it enters and leaves the column."""
    out = steps.withColumn("zoom", F.explode(levels))
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    out = out.withColumn("x", F.explode(F.sequence(tile_x(low - ROOM, "zoom"), tile_x(high + ROOM, "zoom"))))
    west = (F.col("x") / F.pow(F.lit(2.0), F.col("zoom")) * 360.0 - 180.0) * float(E7)
    east = west + 360.0 * E7 / F.pow(F.lit(2.0), F.col("zoom"))
    clamp = lambda v: F.greatest(low.cast("double"), F.least(high.cast("double"), v))
    at = lambda v: F.col("y1") + (clamp(v) - F.col("x1")) / (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    upright = F.col("x1") == F.col("x2")
    ends = [F.when(upright, F.col(y).cast("double")).otherwise(at(v)) for y, v in (("y1", west), ("y2", east))]
    rows = F.sequence(tile_y(F.greatest(*ends) + ROOM, "zoom"), tile_y(F.least(*ends) - ROOM, "zoom"))
    return out.withColumn("y", F.explode(rows)).withColumn("t", F.struct(F.col("zoom").alias("zoom"), "x", "y")).drop("zoom", "x", "y")


def _floor_div(n: str, d: str) -> str:
    """n / d rounded down, for decimals, as long; d > 0."""
    return f"(({n}) div ({d}) - case when ({n}) < 0 and ({n}) <> cast((({n}) div ({d})) as decimal(19,0)) * ({d}) then 1 else 0 end)"


def _border(cover: DataFrame, key: str) -> DataFrame:
    """(key, t, px, py, qx, qy): the edges by the tiles of the cover, those of tiles above FINE by their own tiles at FINE: a country's side
    is a few edges long and would else meet every segment of the country. An edge may come more than once."""
    rows = cover.where(F.size("edges") > 0).select(key, F.struct(F.col("zoom").cast("int").alias("zoom"), "x", "y").alias("t"), F.explode("edges").alias("e")).select(key, "t", "e.*")
    wide = rows.where(F.col("t.zoom") < FINE).select(key, *EDGE).distinct().withColumns({s: F.col(e) for s, e in zip(SEGMENT, EDGE)})
    fine = _tiles_of_segments(wide, F.array(F.lit(FINE))).select(key, "t", *EDGE)
    return rows.where(F.col("t.zoom") >= FINE).unionByName(fine)


def crossings(steps: DataFrame, cover: DataFrame, key: str = "country", up: bool = False) -> DataFrame:
    """(way_id, seq, key, at, lon_e7, lat_e7): where segments go into or out of an area. ``at``: parameter along the segment in 2^-62.
    The point is rounded down (or ``up``); on an upright or level border it lies on the border."""
    border = _border(cover, key)
    near = _tiles_of_segments(steps, levels_of(border.select(F.col("t.zoom").alias("zoom")))).join(border, "t").drop("t")
    boxes = [(F.least(a, b) <= F.greatest(c, d)) for a, b, c, d in (("x1", "x2", "px", "qx"), ("px", "qx", "x1", "x2"), ("y1", "y2", "py", "qy"), ("py", "qy", "y1", "y2"))]
    # few pairs are that near; they are made single first, so that the join tests boxes alone
    near = near.where(boxes[0] & boxes[1] & boxes[2] & boxes[3]).dropDuplicates(["way_id", "seq", key, *EDGE])
    c = {k: F.col(k) for k in (*SEGMENT, *EDGE)}
    ex, ey, dx, dy = c["qx"] - c["px"], c["qy"] - c["py"], c["x2"] - c["x1"], c["y2"] - c["y1"]
    near = near.withColumns({
        "from_side": side(ex, ey, c["x1"] - c["px"], c["y1"] - c["py"]), "to_side": side(ex, ey, c["x2"] - c["px"], c["y2"] - c["py"]),
        "p_side": side(dx, dy, c["px"] - c["x1"], c["py"] - c["y1"]), "q_side": side(dx, dy, c["qx"] - c["x1"], c["qy"] - c["y1"]),
    })
    point = lambda v: F.when(F.col(v) != 0, F.col(v) > 0).when(ey != 0, ey < 0).otherwise(ex > 0)
    edge = lambda v: F.when(F.col(v) != 0, F.col(v) > 0).when(dy != 0, dy > 0).otherwise(dx < 0)
    met = near.where((point("from_side") != point("to_side")) & (edge("p_side") != edge("q_side")))
    # decimals for those alone that cross
    before, after = cross(ex, ey, c["x1"] - c["px"], c["y1"] - c["py"]), cross(ex, ey, c["x2"] - c["px"], c["y2"] - c["py"])
    met = met.withColumns({"n": F.abs(before), "d": F.abs(before - after).cast("decimal(38,0)")})
    sign = "-1 * " if up else ""
    along = lambda a, b: F.expr(f"{a} + {sign}{_floor_div(f'cast(n * cast({sign}({b} - {a}) as decimal(19,0)) as decimal(38,0))', 'd')}").cast("long")
    at = F.expr("(cast(n * cast(4611686018427387904 as decimal(19,0)) as decimal(38,0))) div d")
    each = met.select("way_id", "seq", key, at.alias("at"), along("x1", "x2").alias("lon_e7"), along("y1", "y2").alias("lat_e7"))
    odd = each.groupBy("way_id", "seq", key, "at").agg(F.count(F.lit(1)).alias("n"), F.min("lon_e7").alias("lon_e7"), F.min("lat_e7").alias("lat_e7")).where("n % 2 = 1")
    return odd.drop("n")


def slice_lines(way_nodes: DataFrame, areas: DataFrame, key: str = "country", up: bool = False) -> DataFrame:
    """(way_id, piece, country, geom): ways cut at the borders of areas (``outer``, ``holes``; several rows to a country).

    Pieces are numbered from 1 along the way; they end and start at the border's points. What lies outside of all areas is dropped, and
    so are pieces of one point. ``way_nodes``: (way_id, seq, lon_e7, lat_e7), seq from 1 without gaps."""
    cover = build_cover(areas, key)
    rows = way_nodes.select("way_id", "seq", "lon_e7", "lat_e7")
    inside = stored(locate_in(rows, cover, key=key), "located")  # read twice
    place = W.partitionBy("way_id", "seq", key).orderBy("at")
    marked = crossings(segments(rows), cover, key, up).withColumn("k", F.row_number().over(place)).join(inside.select("way_id", "seq", key, F.lit(True).alias("held")), ["way_id", "seq", key], "left")
    enters = F.coalesce("held", F.lit(False)) == (F.col("k") % 2 == 0)
    events = marked.select("way_id", key, "seq", "at", "lon_e7", "lat_e7", enters.alias("start"))
    events = events.unionByName(inside.select("way_id", key, "seq", F.lit(-1).cast("long").alias("at"), "lon_e7", "lat_e7", (F.col("seq") == 1).alias("start")))
    order = W.partitionBy("way_id", key).orderBy("seq", "at")
    parts = events.withColumn("run", F.sum(F.col("start").cast("int")).over(order))
    point = F.struct(F.col("seq").cast("long").alias("seq"), "at", "lon_e7", "lat_e7")
    done = parts.groupBy("way_id", key, "run").agg(F.array_sort(F.collect_list(point)).alias("p"))
    plain = F.transform("p", lambda x: F.struct(x["lon_e7"].alias("lon_e7"), x["lat_e7"].alias("lat_e7")))
    single = lambda g: F.filter(g, lambda x, i: (i == 0) | (x != F.get(g, i - 1)))
    done = done.withColumn("all", plain).withColumn("geom", single(F.col("all"))).where(F.size("geom") > 1)
    number = F.row_number().over(W.partitionBy("way_id").orderBy(F.get("p", 0)["seq"], F.get("p", 0)["at"], key))
    return done.withColumn("piece", number).select("way_id", "piece", F.col(key).alias("country"), "geom")


def _ring_nodes(areas: DataFrame, key: str) -> DataFrame:
    """The rings of areas as ways: way_id is struct(key, ring number)."""
    rings = areas.select(key, F.posexplode(F.concat(F.array("outer"), F.coalesce("holes", F.array().cast(f"array<{POINTS}>")))).alias("n", "ring"))
    owner = rings.withColumn("way_id", F.struct(F.col(key).alias("of"), "n", F.xxhash64("ring").alias("h")))  # an area may have several rows
    return owner.select("way_id", F.posexplode("ring").alias("seq", "p")).select("way_id", (F.col("seq") + 1).alias("seq"), "p.*")


def _turned(areas: DataFrame) -> DataFrame:
    turn = lambda r: F.transform(r, lambda p: F.struct((-p["lon_e7"]).alias("lon_e7"), (-p["lat_e7"]).alias("lat_e7")))
    return areas.withColumns({"outer": turn(F.col("outer")), "holes": F.transform("holes", turn)})


def intersections(a: DataFrame, b: DataFrame, a_key: str = "id", b_key: str = "country") -> DataFrame:
    """(a_key, b_key, parts): what each area of ``a`` has in common with each of ``b``, as multipolygons; both have ``outer`` and ``holes``.

    The border of what is common is made of the parts of a's rings inside of b and of b's rings inside of a. Both are cut by
    :func:`slice_lines`; their ends are the same crossings, rounded alike, so that chaining by shared ends gives the rings, however many
    pieces a concave outline falls into. Points of a count as moved a little to the north-east of b, and points of b to the south-west of
    a, which is the same, so that both cuts agree where borders touch. Rings inside of an odd number of others are holes."""
    cut_a = slice_lines(_ring_nodes(a, a_key), b, b_key).select(F.col("way_id.of").alias("a"), F.col("country").alias("b"), "geom")
    back = {"lon_e7": -F.col("lon_e7"), "lat_e7": -F.col("lat_e7")}
    turned = slice_lines(_ring_nodes(b, b_key).withColumns(back), _turned(a), a_key, up=True)
    cut_b = turned.select(F.col("country").alias("a"), F.col("way_id.of").alias("b"), F.transform("geom", lambda p: F.struct((-p["lon_e7"]).alias("lon_e7"), (-p["lat_e7"]).alias("lat_e7"))).alias("geom"))
    lines = cut_a.unionByName(cut_b).select(F.struct("a", "b").alias("relation_id"), F.lit("ring").alias("role"), "geom").distinct()
    rings = cut(chain(lines).where("ring is not null").select("relation_id", F.sha2(F.col("ring").cast("string"), 256).alias("ring_id"), F.col("ring").alias("outer")))
    found = nested(rings.withColumn("holes", F.array().cast(f"array<{POINTS}>")))
    roles = rings.join(found, ["relation_id", "ring_id"], "left").select("relation_id", F.when(F.coalesce("depth", F.lit(0)) % 2 == 1, "inner").otherwise("outer").alias("role"), F.col("outer").alias("ring"))
    return multipolygons(roles).select(F.col("relation_id.a").alias(a_key), F.col("relation_id.b").alias(b_key), "parts")


def country_lines(ways: DataFrame, way_nodes: DataFrame, areas: DataFrame) -> DataFrame:
    """(id, way_id, piece, country, geom, tags, box): the pieces as features; the tag ``iso_country_code`` says where each lies."""
    pieces = slice_lines(way_nodes, areas).join(ways.select("way_id", "tags"), "way_id")
    code = F.create_map(F.lit("iso_country_code"), F.col("country"))
    own = F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")), lambda k, _: k != "iso_country_code")
    return pieces.withColumns({"id": feature_id("way_id", "piece", 0), "tags": F.map_concat(own, code)}).withColumns(bounds(F.col("geom")))


def country_areas(areas: DataFrame, countries: DataFrame) -> DataFrame:
    """(id, of, piece, country, outer, holes, tags, box): areas cut at the borders of countries, a row for each piece (C2). Pieces of an area
    are numbered from 1 by country and place; the tag ``iso_country_code`` says where each lies. ``areas``: (id, outer, holes, tags),
    ``countries``: (country, outer, holes), both of simple rings."""
    common = intersections(areas.select("id", "outer", "holes"), countries.select("country", "outer", "holes"))
    parts = common.select("id", "country", F.explode("parts").alias("part")).select("id", "country", "part.*")
    number = F.row_number().over(W.partitionBy("id").orderBy("country", "outer"))
    own = F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")), lambda k, _: k != "iso_country_code")
    out = parts.withColumn("piece", number).join(areas.select("id", "tags"), "id")
    out = out.withColumn("tags", F.map_concat(own, F.create_map(F.lit("iso_country_code"), F.col("country"))))
    return out.select((F.col("id") + F.col("piece") * 1000).alias("id"), F.col("id").alias("of"), "piece", "country", "outer", "holes", "tags").withColumns(bounds(F.col("outer")))
