"""Geometry on arrays of struct(lon_e7, lat_e7), in column expressions: exact integer arithmetic, but for the rounded
points where outlines are cut."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadra.functions.tiles import degrees_text

POINTS = "array<struct<lon_e7:bigint,lat_e7:bigint>>"
BOX = ("min_lon_e7", "min_lat_e7", "max_lon_e7", "max_lat_e7")


def bounds(geom: Column) -> dict[str, Column]:
    """The box of a geometry."""
    lon, lat = F.transform(geom, lambda p: p["lon_e7"]), F.transform(geom, lambda p: p["lat_e7"])
    return {"min_lon_e7": F.array_min(lon), "min_lat_e7": F.array_min(lat), "max_lon_e7": F.array_max(lon), "max_lat_e7": F.array_max(lat)}


def is_closed(geom: Column) -> Column:
    return (F.size(geom) > 2) & (F.get(geom, 0) == F.element_at(geom, -1))


def to_wkt(geom: Column, kind: str = "LINESTRING") -> Column:
    """Well-known text; kind is POINT, LINESTRING or POLYGON."""
    inner = F.array_join(F.transform(geom, lambda p: F.concat(degrees_text(p["lon_e7"]), F.lit(" "), degrees_text(p["lat_e7"]))), ", ")
    left, right = ("((", "))") if kind == "POLYGON" else ("(", ")")
    return F.concat(F.lit(f"{kind} {left}"), inner, F.lit(right))


def box_ring(box: dict[str, Column]) -> Column:
    """The outline of a box."""
    p = lambda a, b: F.struct(box[a].alias("lon_e7"), box[b].alias("lat_e7"))
    west, south, east, north = BOX
    return F.array(p(west, south), p(west, north), p(east, north), p(east, south), p(west, south))


def box_wkt(min_lon: Column, min_lat: Column, max_lon: Column, max_lat: Column) -> Column:
    return F.when(min_lon.isNotNull(), to_wkt(box_ring(dict(zip(BOX, (min_lon, min_lat, max_lon, max_lat), strict=True))), "POLYGON"))


def area2(ring: Column) -> Column:
    """Twice the area of a ring, in square e7 units, as decimal (X8): the shoelace sum does not fit a long."""
    n = F.size(ring)
    dec = lambda v: v.cast("decimal(19,0)")
    terms = F.transform(
        F.slice(ring, 1, F.greatest(n - 1, F.lit(0))),
        lambda p, i: (dec(p["lon_e7"]) * dec(F.get(ring, i + 1)["lat_e7"]) - dec(F.get(ring, i + 1)["lon_e7"]) * dec(p["lat_e7"])).cast("decimal(38,0)"),
    )
    return F.abs(F.aggregate(terms, F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)")))


def boxes_meet(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Two boxes share at least a border point."""
    return (a["min_lon_e7"] <= b["max_lon_e7"]) & (b["min_lon_e7"] <= a["max_lon_e7"]) & (a["min_lat_e7"] <= b["max_lat_e7"]) & (b["min_lat_e7"] <= a["max_lat_e7"])


def box_columns(prefix: str = "") -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in BOX}


def box_intersection(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """The common box; where there is none, min lies above max (X7 for boxes)."""
    return {c: (F.greatest if c.startswith("min") else F.least)(a[c], b[c]) for c in BOX}


def point_in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Ray cast (X9): inside, with the lower and left border inside. Products stay below 2^63 for e7 degrees."""
    def crosses(p, i):
        q = F.get(ring, i + 1)
        over = (p["lat_e7"] > lat) != (q["lat_e7"] > lat)
        left = (lon - p["lon_e7"]).cast("decimal(19,0)") * (q["lat_e7"] - p["lat_e7"]).cast("decimal(19,0)")
        right = (q["lon_e7"] - p["lon_e7"]).cast("decimal(19,0)") * (lat - p["lat_e7"]).cast("decimal(19,0)")
        return over & F.when(q["lat_e7"] > p["lat_e7"], left < right).otherwise(left > right)

    sides = F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), crosses)
    return F.size(F.filter(sides, lambda s: s)) % 2 == 1


def polyline_meets_box(geom: Column, box: dict[str, Column]) -> Column:
    """Some segment has a point in the closed box (X10). Exact: a segment meets a box if their boxes meet and the box's
    corners do not all lie strictly on one side of the segment's line. The corners farthest to either side follow from the segment's
    direction; products, which stay below 2^63 for e7 degrees, are compared and not subtracted."""

    def segment(p, i):
        q = F.get(geom, i + 1)
        near = (
            (F.least(p["lon_e7"], q["lon_e7"]) <= box["max_lon_e7"]) & (F.greatest(p["lon_e7"], q["lon_e7"]) >= box["min_lon_e7"])
            & (F.least(p["lat_e7"], q["lat_e7"]) <= box["max_lat_e7"]) & (F.greatest(p["lat_e7"], q["lat_e7"]) >= box["min_lat_e7"])
        )
        dx, dy = q["lon_e7"] - p["lon_e7"], q["lat_e7"] - p["lat_e7"]
        pick = lambda d, up, down: F.when(d >= 0, box[up]).otherwise(box[down])
        left = dx * (pick(dx, "max_lat_e7", "min_lat_e7") - p["lat_e7"]) >= dy * (pick(dy, "min_lon_e7", "max_lon_e7") - p["lon_e7"])
        right = dx * (pick(dx, "min_lat_e7", "max_lat_e7") - p["lat_e7"]) <= dy * (pick(dy, "max_lon_e7", "min_lon_e7") - p["lon_e7"])
        return near & left & right

    one = F.get(geom, 0)
    single = (one["lon_e7"].between(box["min_lon_e7"], box["max_lon_e7"])) & (one["lat_e7"].between(box["min_lat_e7"], box["max_lat_e7"]))
    parts = F.transform(F.slice(geom, 1, F.greatest(F.size(geom) - 1, F.lit(0))), segment)
    return F.when(F.size(geom) == 1, single).otherwise(F.exists(parts, lambda s: s))


def polygon_meets_box(ring: Column, box: dict[str, Column]) -> Column:
    """The ring's line meets the box, or the box lies inside of the ring."""
    return polyline_meets_box(ring, box) | point_in_ring(box["min_lon_e7"], box["min_lat_e7"], ring)


def holes_cover(holes: Column, box: dict[str, Column]) -> Column:
    """One of the holes holds the whole box (X12): all corners inside, and the hole's line stays outside."""
    inside = lambda ring: (
        point_in_ring(box["min_lon_e7"], box["min_lat_e7"], ring) & point_in_ring(box["max_lon_e7"], box["max_lat_e7"], ring)
        & point_in_ring(box["min_lon_e7"], box["max_lat_e7"], ring) & point_in_ring(box["max_lon_e7"], box["min_lat_e7"], ring)
        & ~polyline_meets_box(ring, box)
    )
    return F.exists(holes, inside)


def feature_id(osm, piece, section) -> Column:
    """Identifier of a feature (X16): source id, country piece and way section in one long."""
    return F.col(osm) * 1_000_000 + (F.col(piece) if isinstance(piece, str) else F.lit(piece)) * 1000 + (F.col(section) if isinstance(section, str) else F.lit(section))


def region_meets_box(outer: Column, holes: Column, box: dict[str, Column]) -> Column:
    """A polygon with holes has a point in the closed box: its outline meets the box, and no hole holds the whole box."""
    return polygon_meets_box(outer, box) & ~F.coalesce(holes_cover(holes, box), F.lit(False))


def _bound(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` reads it."""
    return F.get(F.transform(F.array(value), f), 0)


def _clip_side(ring: Column, axis: str, at: Column, sign: int) -> Column:
    """An open outline against one side of a box: points outside go, crossings come in, rounded to whole units."""
    other = "lat_e7" if axis == "lon_e7" else "lon_e7"

    def cut(r: Column) -> Column:
        def side(a, i):
            b = F.get(r, F.when(i + 1 < F.size(r), i + 1).otherwise(0))
            inside = lambda p: (sign * (p[axis] - at)) >= 0
            along = F.round(a[other] + (at - a[axis]).cast("double") / (b[axis] - a[axis]).cast("double") * (b[other] - a[other])).cast("long")
            parts = {axis: at.cast("long"), other: along}
            crossing = F.struct(*[parts[c].alias(c) for c in ("lon_e7", "lat_e7")])
            none = F.array().cast(POINTS)
            return F.concat(F.when(inside(a), F.array(a)).otherwise(none), F.when(inside(a) != inside(b), F.array(crossing)).otherwise(none))

        return F.flatten(F.transform(r, side))

    return _bound(ring, cut)


def clip_ring(ring: Column, box: dict[str, Column]) -> Column:
    """The part of an outline inside a box (X7), closed; empty if there is none."""
    closed = lambda r: (F.size(r) > 1) & (F.get(r, 0) == F.element_at(r, -1))
    r = _bound(ring, lambda r: F.when(closed(r), F.slice(r, 1, F.size(r) - 1)).otherwise(r))
    for axis, side, sign in (("lon_e7", "min_lon_e7", 1), ("lon_e7", "max_lon_e7", -1), ("lat_e7", "min_lat_e7", 1), ("lat_e7", "max_lat_e7", -1)):
        r = _clip_side(r, axis, box[side], sign)
    single = _bound(r, lambda r: F.filter(r, lambda p, i: p != F.get(r, F.when(i > 0, i - 1).otherwise(F.size(r) - 1))))
    return _bound(single, lambda r: F.when(F.size(r) > 2, F.concat(r, F.slice(r, 1, 1))).otherwise(F.array().cast(POINTS)))
