"""Spatial joins as equi-joins on tiles, with the exact test afterwards.

Each box has a level of its own: the deepest zoom at which it spans at most two tiles each way, so that small boxes have
small tiles, however crowded their city is. Two boxes that meet share a tile at the lower of their two levels: the
box of the lower level lists its own tiles, the other one the tiles above its own, at those levels only that some box of the
other side has. A pair is kept in one shared tile only, that with the smallest row and column, so that no distinct is
needed afterwards.

Areas are boxes, or regions: with the columns ``outer`` (a ring) and ``holes`` (an array of rings) beside their box. A country
may have several rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.functions.geometry import BOX, POINTS, bounds, box_columns, box_intersection, box_ring, boxes_meet, region_meets_box
from quadra.functions.tiles import expand_bbox, tile_x, tile_y
from quadra.operators.cover import build_cover, levels_of, locate_in
from quadra.session import stored

#: The deepest level, and the level at which areas are listed for points.
DEEP, COARSE = 14, 6
#: Tile borders are rounded to 1e-7 degree; a box is taken as larger by so many of them when its tiles are listed.
SLACK = 2


def _placed(df: DataFrame, p: str) -> DataFrame:
    """Adds the level of each box (``tz``) and the tiles that it spans at DEEP (``tx0``, ``tx1``, ``ty0``, ``ty1``)."""
    box = {c: F.col(p + c) + (-SLACK if c.startswith("min") else SLACK) for c in BOX}
    out = df.withColumns({
        p + "tx0": tile_x(box["min_lon_e7"], F.lit(DEEP)), p + "tx1": tile_x(box["max_lon_e7"], F.lit(DEEP)),
        p + "ty0": tile_y(box["max_lat_e7"], F.lit(DEEP)), p + "ty1": tile_y(box["min_lat_e7"], F.lit(DEEP)),
    })
    span = F.greatest(F.col(p + "tx1") - F.col(p + "tx0"), F.col(p + "ty1") - F.col(p + "ty0"), F.lit(1))
    return out.withColumn(p + "tz", F.greatest(F.lit(0), DEEP - F.ceil(F.log2(span)).cast("int")))


def _listed(df: DataFrame, p: str, zooms: Column) -> DataFrame:
    """A row for each tile (``t``) that a box spans at each of ``zooms``."""
    at = lambda c: F.expr(f"shiftright({p}{c}, {DEEP} - __zoom)")
    out = df.withColumn("__zoom", F.explode(zooms)).withColumn("__x", F.explode(F.sequence(at("tx0"), at("tx1")))).withColumn("__y", F.explode(F.sequence(at("ty0"), at("ty1"))))
    return out.withColumn(p + "t", F.struct(F.col("__zoom").alias("zoom"), F.col("__x").alias("x"), F.col("__y").alias("y"))).drop("__zoom", "__x", "__y")


def join_boxes(a: DataFrame, b: DataFrame, more: list[tuple[str, str]] = (), large: bool = False) -> DataFrame:
    """All pairs of rows whose boxes meet (closed). Columns of ``a`` get the prefix ``a_``, those of ``b`` ``b_``. ``more``:
    further pairs of columns that must be equal. Empty boxes (min above max) meet nothing. ``large``: both sides grow with the data, so that
    neither is sent to all tasks, see :func:`_shuffled`."""
    full = lambda d: d.where((F.col("min_lon_e7") <= F.col("max_lon_e7")) & (F.col("min_lat_e7") <= F.col("max_lat_e7")))
    left = _placed(full(a).select([F.col(c).alias("a_" + c) for c in a.columns]), "a_")
    right = _placed(full(b).select([F.col(c).alias("b_" + c) for c in b.columns]), "b_")
    own = lambda p: F.array(F.col(p + "tz"))
    left_levels, right_levels = levels_of(left, "a_tz"), levels_of(right, "b_tz")
    on = F.col("a_t") == F.col("b_t")
    for x, y in more:
        on = on & (F.col("a_" + x) == F.col("b_" + y))
    met = _shuffled if large else lambda df: df
    below = met(_listed(left, "a_", F.array_intersect(F.sequence(F.lit(0), F.col("a_tz")), right_levels))).join(_listed(right, "b_", own("b_")), on)
    above = met(_listed(left, "a_", own("a_"))).join(_listed(right.where("b_tz > 0"), "b_", F.array_intersect(F.sequence(F.lit(0), F.col("b_tz") - 1), left_levels)), on)
    up = lambda c: F.expr(f"shiftright(greatest(a_{c}, b_{c}), {DEEP} - a_t.zoom)")
    home = (F.col("a_t.x") == up("tx0")) & (F.col("a_t.y") == up("ty0"))
    pairs = below.unionByName(above).where(home & boxes_meet(box_columns("a_"), box_columns("b_")))
    return pairs.drop(*[p + c for p in ("a_", "b_") for c in ("tx0", "tx1", "ty0", "ty1", "tz", "t")])


def _shuffled(df: DataFrame) -> DataFrame:
    """For a join of two tables that grow with the data. Spark goes by the size of the compressed files that a table comes from, not by
    how many tiles each of its rows lists, and would send tables of several hundred MB through the driver."""
    return df.hint("merge")


def join_cells(a: DataFrame, b: DataFrame, more: list[tuple[str, str]] = ()) -> DataFrame:
    """The pairs of :func:`join_boxes`, for many and wide rows in ``a`` and narrow ones in ``b``, such as leaves. A row of ``a`` travels
    once for each tile that it spans one level above its own, mostly one, and not once for each level that ``b`` has: only the
    distinct tiles of ``a``, which are stored, are joined with ``b`` over the levels. A tile is one number here, for short rows."""
    full = lambda d: d.where((F.col("min_lon_e7") <= F.col("max_lon_e7")) & (F.col("min_lat_e7") <= F.col("max_lat_e7")))
    left = _placed(full(a).select([F.col(c).alias("a_" + c) for c in a.columns]), "a_").withColumn("a_tz", F.greatest(F.lit(0), F.col("a_tz") - 1))
    spans = lambda c: F.explode(F.expr(f"sequence(shiftright(a_{c}0, {DEEP} - a_tz), shiftright(a_{c}1, {DEEP} - a_tz))"))
    left = left.withColumn("__x", spans("tx")).withColumn("__y", spans("ty")).withColumn("a_t", _number("a_tz", "__x", "__y"))
    # of the tiles that a row spans it keeps for each copy whether it is the first column and the first row, not their numbers
    first = {f"a_f{c}": F.expr(f"__{c} = shiftright(a_t{c}0, {DEEP} - a_tz)") for c in "xy"}
    left = left.withColumns(first).select(*["a_" + c for c in a.columns], "a_t", *first)
    cells = stored(left.select(F.col("a_t").alias("cell")).distinct(), "cells")
    right = _placed(full(b).select([F.col(c).alias("b_" + c) for c in b.columns]), "b_").withColumn("__b", F.monotonically_increasing_id())
    right = stored(right, "numbered")
    near = _shuffled(_near(cells, right)).join(right.drop("b_tx1", "b_ty1", "b_tz"), "__b").drop("__b")
    on = F.col("a_t") == F.col("cell")
    for x, y in more:
        on = on & (F.col("a_" + x) == F.col("b_" + y))
    pairs = _shuffled(left).join(near, on)
    # a pair is kept in the tile that is the first one, each way, of those that both span
    at = {"x": "shiftright(a_t, 20) & 1048575L", "y": "a_t & 1048575L"}
    up = {c: F.expr(f"shiftright(b_t{c}0, {DEEP} - int(shiftright(a_t, 40)))") for c in at}
    home = [F.when(F.col("a_f" + c), up[c] <= F.expr(v)).otherwise(up[c] == F.expr(v)) for c, v in at.items()]
    pairs = pairs.where(home[0] & home[1] & boxes_meet(box_columns("a_"), box_columns("b_")))
    return pairs.select(*["a_" + c for c in a.columns], *["b_" + c for c in b.columns])


def _number(zoom: str, x: str, y: str) -> Column:
    return F.expr(f"shiftleft(bigint({zoom}), 40) + shiftleft(bigint({x}), 20) + {y}")


def _near(cells: DataFrame, placed: DataFrame) -> DataFrame:
    """(cell, __b): the boxes that span a part of each cell, by the tiles at DEEP, each pair once. ``cells``: (cell), a tile as a number;
    ``placed``: (__b, b_tz and the spanned tiles, see :func:`_placed`). A box of the cell's level or a deeper one lists the tiles that it spans at
    the levels that cells have; of one of a lower level the cell looks up the single tile above itself."""
    c = cells.withColumns({"z": F.expr("int(shiftright(cell, 40))"), "x": F.expr("shiftright(cell, 20) & 1048575L"), "y": F.expr("cell & 1048575L")})
    b = placed.select("__b", "b_tz", "b_tx0", "b_tx1", "b_ty0", "b_ty1")
    cell_levels, levels = levels_of(c, "z"), levels_of(b, "b_tz")
    number = _number("b_t.zoom", "b_t.x", "b_t.y").alias("cell")
    above = _shuffled(c.select("cell")).join(_listed(b, "b_", F.array_intersect(F.sequence(F.lit(0), "b_tz"), cell_levels)).select("__b", number), "cell")
    over = c.where("z > 0").withColumn("__z", F.explode(F.array_intersect(F.sequence(F.lit(0), F.col("z") - 1), levels)))
    over = over.select("cell", _number("__z", "shiftright(x, z - __z)", "shiftright(y, z - __z)").alias("__t"))
    own = _listed(b, "b_", F.array("b_tz")).select("__b", number.alias("__t"), "b_tx0", "b_tx1", "b_ty0", "b_ty1")
    first = {"x": "shiftright(cell, 20) & 1048575L", "y": "cell & 1048575L"}
    low = {k: F.expr(f"shiftleft({v}, {DEEP} - int(shiftright(cell, 40)))") for k, v in first.items()}
    high = {k: F.expr(f"shiftleft(({v}) + 1, {DEEP} - int(shiftright(cell, 40))) - 1") for k, v in first.items()}
    meet = (low["x"] <= F.col("b_tx1")) & (high["x"] >= F.col("b_tx0")) & (low["y"] <= F.col("b_ty1")) & (high["y"] >= F.col("b_ty0"))
    below = _shuffled(over).join(own, "__t").where(meet)
    return above.select("cell", "__b").unionByName(below.select("cell", "__b"))


def _region(areas: DataFrame) -> list[str]:
    return [c for c in ("outer", "holes") if c in areas.columns]


def locate(points: DataFrame, areas: DataFrame, lon: str = "lon_e7", lat: str = "lat_e7") -> DataFrame:
    """Points with the columns of each area that holds them; the lower and left border belong to an area. Box areas are listed by
    the tiles of one coarse zoom, at most 4^COARSE to an area; a point is in one of them. Regions (of a country) are looked up in
    their cover, and only the country is added."""
    if _region(areas):
        return locate_in(points, build_cover(areas), lon, lat)
    spread = _listed(_placed(areas.withColumnsRenamed({c: "k_" + c for c in BOX}), "k_"), "k_", F.array(F.lit(COARSE))).drop("k_tx0", "k_tx1", "k_ty0", "k_ty1", "k_tz")
    at = F.struct(F.lit(COARSE).alias("zoom"), tile_x(lon, F.lit(COARSE)).alias("x"), tile_y(lat, F.lit(COARSE)).alias("y"))
    pairs = points.withColumn("__t", at).join(spread, F.col("__t") == F.col("k_t")).drop("__t", "k_t")
    x, y = F.col(lon), F.col(lat)
    inside = (x >= F.col("k_min_lon_e7")) & (x < F.col("k_max_lon_e7")) & (y >= F.col("k_min_lat_e7")) & (y < F.col("k_max_lat_e7"))
    return pairs.where(inside).withColumnsRenamed({"k_" + c: c for c in BOX})


def country_shards(tiles: DataFrame, boundaries: DataFrame, more: list[str] = ()) -> DataFrame:
    """(country, zoom, x, y) of all leaf tiles that meet a country, a box or a region (J1). ``more``: what to keep of a tile besides, such as
    its box, so that shards are not joined with the tiles again."""
    leaf = tiles.where("final").select("zoom", "x", "y", *BOX)
    region = _region(boundaries)
    pairs = join_boxes(leaf, boundaries.select("country", *BOX, *region))
    if region:
        pairs = pairs.where(region_meets_box(F.col("b_outer"), F.col("b_holes"), box_columns("a_")))
    out = pairs.select(F.col("b_country").alias("country"), *[F.col("a_" + c).alias(c) for c in ("zoom", "x", "y", *more)])
    return out.distinct() if region else out


def tasks(shards: DataFrame) -> DataFrame:
    """Each (country, shard) with the number of the country's shards and their sorted names (J2); joined back on the
    country, so that no window holds a whole country."""
    name = F.concat_ws("-", "zoom", "x", "y")
    all_of = shards.groupBy("country").agg(F.array_sort(F.collect_set(name)).alias("all_shards"))
    return shards.select("country", name.alias("shard")).join(all_of, "country")


def shards_of_boxes(df: DataFrame, tiles: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., zoom, x, y): the leaf tiles that each box meets."""
    pairs = join_boxes(df.select(*dict.fromkeys([*keep, *BOX])), tiles.where("final").select("zoom", "x", "y", *BOX))
    return pairs.select(*[F.col("a_" + c).alias(c) for c in keep], F.col("b_zoom").alias("zoom"), F.col("b_x").alias("x"), F.col("b_y").alias("y"))


def shards_of_points(df: DataFrame, tiles: DataFrame, max_zoom: int = 14) -> DataFrame:
    """Adds zoom, x, y of the leaf that holds a point: the point's tiles, at the zooms that leaves have, against the leaves."""
    leaves = tiles.where("final").select(F.col("zoom").cast("int").alias("zoom"), "x", "y")
    up = lambda c: F.expr(f"shiftright({c}, {max_zoom} - zoom)").alias(c)
    deep = df.withColumns({"x": tile_x("lon_e7", F.lit(max_zoom)), "y": tile_y("lat_e7", F.lit(max_zoom)), "zoom": F.explode(levels_of(leaves))})
    deep = deep.select(*df.columns, "zoom", up("x"), up("y"))
    return deep.join(leaves, ["zoom", "x", "y"]).select(*df.columns, "zoom", "x", "y")


def leaves_holding(df: DataFrame, leaves: DataFrame) -> DataFrame:
    """Adds zoom, x, y of the leaf whose box holds a point. Unlike :func:`shards_of_points`, which goes by the tile's number (the upper
    border belongs to a tile), a leaf is its box, rounded to 1e-7 degree, with its lower and left border. The point's tiles and those
    within SLACK of it are looked up, and the box decides. The world's outer tiles have no outer border. ``leaves``: (zoom, x, y, box)."""
    near = [F.struct(tile_x(F.col("lon_e7") + i * SLACK, F.lit(DEEP)).alias("x"), tile_y(F.col("lat_e7") + j * SLACK, F.lit(DEEP)).alias("y")) for i in (-1, 1) for j in (-1, 1)]
    zoom = F.explode(levels_of(leaves.withColumn("zoom", F.col("zoom").cast("int")))).alias("__zoom")
    at = df.withColumn("__near", F.array_distinct(F.array(*near))).select("*", zoom)
    up = F.transform("__near", lambda t: F.struct(F.expr(f"{DEEP} - __zoom").alias("s"), t["x"].alias("x"), t["y"].alias("y")))
    up = F.transform(up, lambda t: F.struct(F.call_function("shiftright", t["x"], t["s"]).alias("x"), F.call_function("shiftright", t["y"], t["s"]).alias("y")))
    at = at.withColumn("__t", F.explode(F.array_distinct(up))).select(*df.columns, F.col("__zoom").alias("zoom"), "__t.x", "__t.y")
    b = leaves.select(F.col("zoom").cast("int").alias("zoom"), "x", "y", *[F.col(c).alias("t_" + c) for c in BOX])
    last = F.expr("shiftleft(1L, zoom) - 1")
    lon = ((F.col("lon_e7") >= F.col("t_min_lon_e7")) | (F.col("x") == 0)) & ((F.col("lon_e7") < F.col("t_max_lon_e7")) | (F.col("x") == last))
    lat = ((F.col("lat_e7") >= F.col("t_min_lat_e7")) | (F.col("y") == last)) & ((F.col("lat_e7") < F.col("t_max_lat_e7")) | (F.col("y") == 0))
    return at.join(b, ["zoom", "x", "y"]).where(lon & lat).select(*df.columns, "zoom", "x", "y")


def fan_out(relations: DataFrame, tiles: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Relation to shard to country (J9): a shard stays if the relation's box and the country both meet it and each other."""
    shards = shards_of_boxes(relations, tiles, ["relation_id", *BOX])
    region = _region(boundaries)
    listed = country_shards(tiles, boundaries).join(boundaries.select("country", *region, *[F.col(c).alias("k_" + c) for c in BOX]), "country")
    met = shards.join(listed, ["zoom", "x", "y"]).where(boxes_meet(box_columns(), box_columns("k_")))
    if region:
        met = met.where(region_meets_box(F.col("outer"), F.col("holes"), box_columns()))
    out = met.select("relation_id", "country", "zoom", "x", "y")
    return out.distinct() if region else out


def input_tiles(areas: DataFrame, tiles: DataFrame, holes: DataFrame, files: DataFrame) -> DataFrame:
    """Tiles to read for loading areas (J11): those that meet one, without those that a hole covers, if their file is
    listed with a length above 0. ``areas``: (area, box), or regions, whose own holes count; ``holes``: (area, box), further
    ones; ``files``: (zoom, x, y, length)."""
    region = _region(areas)
    met = join_boxes(areas.select("area", *BOX, *region), tiles.where("final").select("zoom", "x", "y", *BOX))
    if region:
        met = met.where(region_meets_box(F.col("a_outer"), F.col("a_holes"), box_columns("b_")))
    met = met.select(F.col("a_area").alias("area"), *[F.col("b_" + c).alias(c) for c in ("zoom", "x", "y", *BOX)]).distinct()
    covered = join_boxes(met, holes, [("area", "area")]).where(
        (F.col("b_min_lon_e7") <= F.col("a_min_lon_e7")) & (F.col("b_min_lat_e7") <= F.col("a_min_lat_e7")) & (F.col("b_max_lon_e7") >= F.col("a_max_lon_e7")) & (F.col("b_max_lat_e7") >= F.col("a_max_lat_e7"))
    ).select(*[F.col("a_" + c).alias(c) for c in ("area", "zoom", "x", "y")])
    there = files.where("length > 0").select("zoom", "x", "y")
    return met.join(covered, ["area", "zoom", "x", "y"], "left_anti").join(there, ["zoom", "x", "y"], "left_semi").select("area", "zoom", "x", "y")


def loading_areas(shards: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(country, zoom, x, y, box): the common box of a shard and its country (X7); shards that only touch it are dropped.
    ``shards``: (country, zoom, x, y, box). For regions also ``outer`` and ``holes``: what shard and country have in common, a row for
    each piece that it falls into."""
    if _region(boundaries):
        return _loading_regions(shards, boundaries)
    b = boundaries.select("country", *[F.col(c).alias("k_" + c) for c in BOX])
    cut = shards.join(b, "country").withColumns(box_intersection(box_columns(), box_columns("k_")))
    cut = cut.where("min_lon_e7 < max_lon_e7 and min_lat_e7 < max_lat_e7")
    return cut.select("country", "zoom", "x", "y", *BOX)


def _loading_regions(shards: DataFrame, boundaries: DataFrame) -> DataFrame:
    from quadra.plans.slicing import intersections

    tiles = shards.select(F.struct("zoom", "x", "y").alias("tile"), box_ring(box_columns()).alias("outer"), F.array().cast(f"array<{POINTS}>").alias("holes")).distinct()
    common = intersections(tiles, boundaries.select("country", "outer", "holes"), "tile", "country")
    parts = common.select("country", "tile.*", F.explode("parts").alias("part")).select("country", "zoom", "x", "y", "part.*").withColumns(bounds(F.col("outer")))
    return parts.join(shards.select("country", "zoom", "x", "y").distinct(), ["country", "zoom", "x", "y"], "left_semi")


def neighbours(shards: DataFrame, metres: float | None) -> DataFrame:
    """(country, origin, neighbour): the country's shards within a distance of each shard, itself included (C6); the
    distance 0 stands for no expansion. ``shards``: (country, shard, box)."""
    if metres == 0:
        return shards.select("country", F.col("shard").alias("origin"), F.col("shard").alias("neighbour"))
    grown = shards.withColumns(expand_bbox("min_lon_e7", "min_lat_e7", "max_lon_e7", "max_lat_e7", F.lit(metres).cast("double")))
    pairs = join_boxes(grown, shards, [("country", "country")], large=True)
    return pairs.select(F.col("a_country").alias("country"), F.col("a_shard").alias("origin"), F.col("b_shard").alias("neighbour"))


def fetch(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Features of the requested shards, once for each origin (J4); requested shards without data give no rows."""
    return requests.join(features.withColumnRenamed("shard", "neighbour"), ["country", "neighbour"]).withColumnRenamed("neighbour", "shard")


def fetch_all_countries(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Like :func:`fetch`, over all countries of a tile (J12); a feature that several of them hold is taken from the
    first country. It is found where the join has brought the tile's rows together."""
    rows = requests.withColumnRenamed("country", "for_country").join(features.withColumnRenamed("shard", "neighbour"), "neighbour")
    first = F.min("country").over(W.partitionBy("for_country", "origin", "neighbour", "item_type", "id"))
    return rows.withColumn("__first", first).where("country = __first").drop("__first").withColumnRenamed("neighbour", "shard")


def duplicate_requests(requests: DataFrame) -> DataFrame:
    """Neighbours that an origin asks for more than once (A8); there should be none."""
    return requests.groupBy("country", "origin", "neighbour").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def prove_missing(missing: DataFrame, nodes: DataFrame, boundaries: DataFrame, ignored: DataFrame, skipped: DataFrame) -> DataFrame:
    """Missing shards that hold a node that should be there (J14): per shard the lowest such node and their number.

    ``missing``: (country, zoom, x, y, box); ``nodes``: (node_id, lon_e7, lat_e7); nodes of ``ignored`` and ``skipped``
    (node_id) do not count. A node lies in one leaf, which is looked up among the missing ones first. The lower and left border
    belong to a shard's box, a country's box or a region."""
    leaves = missing.select("zoom", "x", "y", *BOX).distinct()
    usable = nodes.join(ignored, "node_id", "left_anti").join(skipped, "node_id", "left_anti")
    placed = leaves_holding(usable.select("node_id", "lon_e7", "lat_e7"), leaves)
    held = locate(placed, boundaries.select("country", *_region(boundaries), *BOX)).join(missing.select("country", "zoom", "x", "y").distinct(), ["country", "zoom", "x", "y"])
    return held.groupBy("country", "zoom", "x", "y").agg(F.min("node_id").alias("node_id"), F.count(F.lit(1)).alias("nodes"))
