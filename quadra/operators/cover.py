"""A cover index of polygons: tiles that lie inside, and border tiles that hold their own few edges.

A country may have a hundred thousand corners and hold a third of all points. Its edges are dealt out to tiles, from the tiles of the
country's own size downward, until a tile has at most EDGES of them; tiles without edges are inside or outside as a whole. A point
then meets one tile of the index, and at most the edges of that tile; no outline is carried to the points.

Inside means an odd number of edges on the way to the east (all rings of an area count, so that holes and further parts need no
case of their own), with the lower and left border inside. A border tile has the answer for its south-east corner; a point's answer
follows from it by the edges that cross the way from the point eastward to the tile's side, and along that side to the corner. Both
ways stay in the tile, so that its own edges are enough. All tests are exact: points count as moved a little to the east and,
by much less, to the north, which leaves no point on an edge. The corner of a tile is carried from the tile above it in the same
way, so that each level reads a tile's own edges only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.functions.geometry import BOX
from quadra.functions.tiles import WORLD, tile_bounds, tile_x, tile_y
from quadra.session import cut

#: Edges of a border tile above which it is split, and the deepest tiles.
EDGES, DEEP = 16, 14
#: Tile borders are rounded; edges this near to a tile count as its own.
SLACK = 2
EDGE = ("px", "py", "qx", "qy")
_TILE = ["zoom", "x", "y"]


def _dec(v: Column) -> Column:
    return v.cast("decimal(19,0)")


def cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Cross product of two differences of coordinates, exact."""
    return (_dec(ax) * _dec(by) - _dec(ay) * _dec(bx)).cast("decimal(38,0)")


def side(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """The sign of :func:`cross`, exact without decimals: a difference in longitude times one in latitude stays below 2^63 for e7 degrees, so
    that the two products are compared and not subtracted."""
    left, right = ax * by, ay * bx
    return F.when(left > right, 1).when(left < right, -1).otherwise(0)


def ring_edges(areas: DataFrame, key: str) -> DataFrame:
    """(key, px, py, qx, qy): the edges of all rings (``outer`` and ``holes``) of an area, in their direction."""
    rings = areas.select(key, F.explode(F.concat(F.array("outer"), F.coalesce("holes", F.array().cast("array<array<struct<lon_e7:bigint,lat_e7:bigint>>>")))).alias("ring"))
    sides = F.transform(
        F.slice("ring", 1, F.greatest(F.size("ring") - 1, F.lit(0))),
        lambda p, i: F.struct(p["lon_e7"].alias("px"), p["lat_e7"].alias("py"), F.get(F.col("ring"), i + 1)["lon_e7"].alias("qx"), F.get(F.col("ring"), i + 1)["lat_e7"].alias("qy")),
    )
    return rings.select(key, F.explode(sides).alias("e")).select(key, "e.*").where("px <> qx or py <> qy")


def east_of(e: dict[str, Column], x: Column, y: Column) -> Column:
    """The edge crosses the latitude ``y``, to the east of ``x``."""
    over = (e["py"] > y) != (e["qy"] > y)
    turn = side(e["qx"] - e["px"], e["qy"] - e["py"], x - e["px"], y - e["py"])
    return over & F.when(e["qy"] > e["py"], turn > 0).otherwise(turn < 0)


def _north_of(e: dict[str, Column], x: Column, y: Column) -> Column:
    """Where the edge crosses the longitude ``x``, it is to the north of ``y``."""
    turn = side(e["qx"] - e["px"], e["qy"] - e["py"], x - e["px"], y - e["py"])
    rising = (e["qy"] > e["py"]) == (e["qx"] > e["px"])
    above = F.when(e["qx"] > e["px"], turn < 0).otherwise(turn > 0)
    return above | ((turn == 0) & (e["qy"] != e["py"]) & rising)


def turns(e: dict[str, Column], x: Column, y: Column, corner_x: Column, corner_y: Column) -> Column:
    """The edge changes the answer between a point and a corner: eastward to the corner's longitude, and along that."""
    along = east_of(e, x, y) != east_of(e, corner_x, y)
    spans = (e["px"] > corner_x) != (e["qx"] > corner_x)
    return along != (spans & (_north_of(e, corner_x, y) != _north_of(e, corner_x, corner_y)))


def tile_box(zoom, x, y) -> dict[str, Column]:
    """A tile's box; the first and last row reach to the poles."""
    box = tile_bounds(zoom, x, y)
    z, row = F.col(zoom), F.col(y)
    box["max_lat_e7"] = F.when(row == 0, F.lit(WORLD[3])).otherwise(box["max_lat_e7"]).cast("long")
    box["min_lat_e7"] = F.when(row == F.pow(F.lit(2.0), z) - 1, F.lit(WORLD[1])).otherwise(box["min_lat_e7"]).cast("long")
    return box


def edge_meets(e: dict[str, Column], box: dict[str, Column]) -> Column:
    """The edge has a point in the box, or nearer to it than SLACK."""
    lo_x, lo_y, hi_x, hi_y = (box[c] + (-SLACK if c.startswith("min") else SLACK) for c in BOX)
    near = (F.least(e["px"], e["qx"]) <= hi_x) & (F.greatest(e["px"], e["qx"]) >= lo_x) & (F.least(e["py"], e["qy"]) <= hi_y) & (F.greatest(e["py"], e["qy"]) >= lo_y)
    turn = lambda x, y: side(e["qx"] - e["px"], e["qy"] - e["py"], x - e["px"], y - e["py"])
    corners = [turn(x, y) for x in (lo_x, hi_x) for y in (lo_y, hi_y)]
    return near & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def _e(prefix: str = "") -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in EDGE}


def _start_tiles(edges: DataFrame, key: str) -> DataFrame:
    """(key, zoom, x, y): the tiles, four at most, that hold each area at its own size."""
    box = edges.groupBy(key).agg(F.min(F.least("px", "qx")).alias("a"), F.min(F.least("py", "qy")).alias("b"), F.max(F.greatest("px", "qx")).alias("c"), F.max(F.greatest("py", "qy")).alias("d"))
    box = box.withColumns({"x0": tile_x(F.col("a") - SLACK, F.lit(DEEP)), "x1": tile_x(F.col("c") + SLACK, F.lit(DEEP)), "y0": tile_y(F.col("d") + SLACK, F.lit(DEEP)), "y1": tile_y(F.col("b") - SLACK, F.lit(DEEP))})
    span = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1))
    box = box.withColumn("zoom", F.greatest(F.lit(0), DEEP - F.ceil(F.log2(span)).cast("int")))
    at = lambda c: F.expr(f"shiftright({c}, {DEEP} - zoom)")
    return box.withColumn("x", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("y", F.explode(F.sequence(at("y0"), at("y1")))).select(key, *_TILE)


def _corner() -> tuple[Column, Column]:
    box = tile_box("zoom", "x", "y")
    return box["max_lon_e7"], box["min_lat_e7"]


def build_cover(areas: DataFrame, key: str = "country", limit: int | None = None) -> DataFrame:
    """(key, zoom, x, y, odd, corner_x, corner_y, edges, span): the tiles that meet each area. Where ``edges`` (array of px, py, qx, qy) is
    empty the tile lies inside; else ``odd`` is the answer for its corner, and ``span`` the box of the whole area. Rows of ``areas`` with one key are one area.

    Ends a level with a checkpoint; a level reads the edges of the tiles that are still too full."""
    limit = EDGES if limit is None else limit
    edges = ring_edges(areas, key)
    corner_x, corner_y = _corner()
    start = edges.join(_start_tiles(edges, key), key)
    tiles = start.groupBy(key, *_TILE).agg((F.count_if(east_of(_e(), corner_x, corner_y)) % 2 == 1).alias("odd"))
    rows = cut(start.where(edge_meets(_e(), tile_box("zoom", "x", "y"))).join(tiles, [key, *_TILE]))
    done = tiles.join(rows.select(key, *_TILE).distinct(), [key, *_TILE], "left_anti").where("odd")
    inner = [done.select(key, *_TILE)]
    border = []
    while True:
        counts = rows.groupBy(key, *_TILE).agg(F.count(F.lit(1)).alias("n"))
        full = counts.where((F.col("n") > limit) & (F.col("zoom") < DEEP)).select(key, *_TILE)
        border.append(rows.join(full, [key, *_TILE], "left_anti"))
        split = rows.join(full, [key, *_TILE], "left_semi")
        if full.isEmpty():
            break
        kids = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
        each = split.withColumns({"from_x": corner_x, "from_y": corner_y}).withColumn("kid", kids)
        each = each.withColumns({"zoom": F.col("zoom") + 1, "x": F.col("x") * 2 + F.col("kid.i"), "y": F.col("y") * 2 + F.col("kid.j")})
        each = each.withColumn("turns", turns(_e(), corner_x, corner_y, F.col("from_x"), F.col("from_y")))
        each = cut(each.withColumn("meets", edge_meets(_e(), tile_box("zoom", "x", "y"))).drop("kid", "from_x", "from_y"))
        kids_of = each.groupBy(key, *_TILE).agg(((F.count_if("turns") + F.first("odd").cast("int")) % 2 == 1).alias("odd"), F.count_if("meets").alias("n"))
        kids_of = cut(kids_of)
        inner.append(kids_of.where("n = 0 and odd").select(key, *_TILE))
        rows = each.where("meets").drop("odd", "turns", "meets").join(kids_of.where("n > 0").select(key, *_TILE, "odd"), [key, *_TILE])
    every = border[0]
    for b in border[1:]:
        every = every.unionByName(b)
    kept = every.groupBy(key, *_TILE).agg(F.first("odd").alias("odd"), F.collect_list(F.struct(*EDGE)).alias("edges"))
    span = {"min_lon_e7": F.min(F.least("px", "qx")), "min_lat_e7": F.min(F.least("py", "qy")), "max_lon_e7": F.max(F.greatest("px", "qx")), "max_lat_e7": F.max(F.greatest("py", "qy"))}
    kept = kept.join(edges.groupBy(key).agg(F.struct(*[v.alias(c) for c, v in span.items()]).alias("span")), key)
    whole = inner[0]
    for i in inner[1:]:
        whole = whole.unionByName(i)
    none = F.array().cast("array<struct<px:bigint,py:bigint,qx:bigint,qy:bigint>>")
    out = kept.unionByName(whole.select("*", F.lit(True).alias("odd"), none.alias("edges")), allowMissingColumns=True)
    return out.withColumns({"corner_x": corner_x, "corner_y": corner_y}).select(key, *_TILE, "odd", "corner_x", "corner_y", "edges", "span")


def levels_of(df: DataFrame, zoom: str = "zoom") -> Column:
    """The zooms that a table has, as an array: a subquery of at most DEEP + 1 values."""
    return F.coalesce(df.agg(F.collect_set(zoom)).scalar(), F.array().cast("array<int>"))


def inside_tile(x: Column, y: Column) -> Column:
    """The answer for a point of a tile of the cover (columns odd, corner_x, corner_y, edges)."""
    changes = F.filter("edges", lambda e: turns({c: e[c] for c in EDGE}, x, y, F.col("corner_x"), F.col("corner_y")))
    return F.when(F.size("edges") == 0, F.lit(True)).otherwise(F.col("odd") != (F.size(changes) % 2 == 1))


def locate_in(points: DataFrame, cover: DataFrame, lon: str = "lon_e7", lat: str = "lat_e7", key: str = "country", on: Column | None = None) -> DataFrame:
    """Points with the key of each area that holds them. A point is listed at the levels of the cover, and meets one tile of each area.
    A crowded tile's points may be split by Spark among tasks, as its few edges are short. ``on``: a further condition on a point's
    columns and the key."""
    deep = points.withColumns({"__x": tile_x(lon, F.lit(DEEP)), "__y": tile_y(lat, F.lit(DEEP))}).withColumn("__zoom", F.explode(levels_of(cover)))
    up = lambda c: F.expr(f"shiftright({c}, {DEEP} - __zoom)")
    at = F.struct(F.col("__zoom").alias("zoom"), up("__x").alias("x"), up("__y").alias("y"))
    keyed = cover.select(key, "odd", "corner_x", "corner_y", "edges", "span", F.struct(F.col("zoom").cast("int").alias("zoom"), "x", "y").alias("__tile"))
    same = F.col("__t") == F.col("__tile")
    # most areas of a border tile are told apart by their boxes, without a look at the edges
    x, y = F.col(lon), F.col(lat)
    near = F.col("span").isNull() | ((x >= F.col("span.min_lon_e7")) & (x <= F.col("span.max_lon_e7")) & (y >= F.col("span.min_lat_e7")) & (y <= F.col("span.max_lat_e7")))
    met = deep.withColumn("__t", at).join(keyed, same if on is None else same & on).where(near & inside_tile(x, y))
    return met.select(*points.columns, key)
