"""Slippy tiles, geohashes and tile names as column expressions. Coordinates are integers in 1e-7 degree (e7)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

E7 = 10_000_000
MAX_ZOOM = 18
MAX_LAT = 85.0511287798
WORLD = (-180 * E7, -90 * E7, 180 * E7, 90 * E7)
#: The path of a tile's file below the output folder, by scheme name.
SCHEMES = {
    "ZZ_XX_YY_PBF": "zz-xx-yy.pbf",
    "ZZ_SLASH_XX_YY_PBF": "zz/xx-yy.pbf",
    "ZZ_XX_YY_SUBFOLDERS_PBF": "zz/xx/yy/zz-xx-yy.pbf",
    "ZZ_XX_YY_OSMPBF": "zz-xx-yy.osm.pbf",
    "ZZ_SLASH_XX_YY_OSMPBF": "zz/xx-yy.osm.pbf",
    "ZZ_SLASH_ZZ_XX_YY_OSMPBF": "zz/zz-xx-yy.osm.pbf",
    "ZZ_XX_YY_SUBFOLDERS_OSMPBF": "zz/xx/yy/zz-xx-yy.osm.pbf",
    "ZZ_SUBFOLDER": "zz/",
    "EMPTY": "",
}


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def tile_x(lon_e7, zoom) -> Column:
    """Column of a longitude's tile."""
    n = F.pow(F.lit(2.0), _c(zoom))
    x = F.floor((_c(lon_e7) / F.lit(float(E7)) + 180.0) / 360.0 * n)
    return F.greatest(F.lit(0), F.least(x, n - 1)).cast("long")


def tile_y(lat_e7, zoom) -> Column:
    """Row of a latitude's tile, counted from the north; latitudes beyond the projection are clamped."""
    n = F.pow(F.lit(2.0), _c(zoom))
    lat = F.radians(F.greatest(F.lit(-MAX_LAT), F.least(F.lit(MAX_LAT), _c(lat_e7) / F.lit(float(E7)))))
    y = F.floor((1.0 - F.ln(F.tan(lat) + 1.0 / F.cos(lat)) / math.pi) / 2.0 * n)
    return F.greatest(F.lit(0), F.least(y, n - 1)).cast("long")


def tile_of(lon_e7, lat_e7, zoom) -> Column:
    """struct(zoom, x, y) of a point; a zoom above MAX_ZOOM is an error."""
    z = _c(zoom)
    checked = F.when(z <= MAX_ZOOM, z).otherwise(F.raise_error(F.concat(F.lit("zoom is too high: "), z.cast("string")))).cast("int")
    return F.struct(checked.alias("zoom"), tile_x(lon_e7, z).alias("x"), tile_y(lat_e7, z).alias("y"))


def _lat_of(y, zoom) -> Column:
    return F.round(F.degrees(F.atan(F.sinh(math.pi * (1.0 - 2.0 * _c(y) / F.pow(F.lit(2.0), _c(zoom)))))) * float(E7)).cast("long")


def _lon_of(x, zoom) -> Column:
    return F.round((_c(x) / F.pow(F.lit(2.0), _c(zoom)) * 360.0 - 180.0) * float(E7)).cast("long")


def tile_bounds(zoom, x, y) -> dict[str, Column]:
    """The tile's box as four columns."""
    return {"min_lon_e7": _lon_of(x, zoom), "min_lat_e7": _lat_of(_c(y) + 1, zoom), "max_lon_e7": _lon_of(_c(x) + 1, zoom), "max_lat_e7": _lat_of(y, zoom)}


def tile_name(zoom, x, y) -> Column:
    """``zoom-x-y``."""
    return F.concat_ws("-", _c(zoom).cast("string"), _c(x).cast("string"), _c(y).cast("string"))


def country_shard(country, zoom, x, y) -> Column:
    """``XYZ_zoom-x-y``."""
    return F.concat_ws("_", _c(country), tile_name(zoom, x, y))


def parse_tile(name) -> Column:
    """struct(zoom, x, y) of a tile name, with or without a country in front; null if it is none."""
    n = F.regexp_extract(_c(name), r"^(?:[A-Za-z0-9]+_)?([0-9]+-[0-9]+-[0-9]+)$", 1)
    part = F.split(F.when(n != "", n), "-")
    return F.when(n != "", F.struct(part[0].cast("int").alias("zoom"), part[1].cast("long").alias("x"), part[2].cast("long").alias("y")))


def geohash(lon_e7, lat_e7, precision: int) -> Column:
    """Geohash of a point (X3): longitude and latitude bits in turns, five bits a letter."""
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    cell = lambda v, low, span, n: F.least(F.floor((_c(v).cast("double") - low * E7) * (2.0**n / (span * float(E7)))), F.lit(2**n - 1)).cast("long")
    lon, lat = cell(lon_e7, -180, 360, lon_bits), cell(lat_e7, -90, 180, lat_bits)
    letters = F.lit("0123456789bcdefghjkmnpqrstuvwxyz")

    def bit(i: int) -> Column:
        v, n, k = (lon, lon_bits, i // 2) if i % 2 == 0 else (lat, lat_bits, i // 2)
        return F.shiftright(v, n - 1 - k).bitwiseAND(F.lit(1).cast("long"))

    def letter(j: int) -> Column:
        value = sum((bit(5 * j + b) * (1 << (4 - b)) for b in range(1, 5)), bit(5 * j) * 16)
        return F.substring(letters, (value + 1).cast("int"), F.lit(1))

    return F.concat(*[letter(j) for j in range(precision)])


def expand_bbox(min_lon, min_lat, max_lon, max_lat, metres) -> dict[str, Column]:
    """The box grown by a distance on all sides (X6); null metres gives the world. One degree of latitude is 111,320 m."""
    m, lo, hi = _c(metres), _c(min_lat), _c(max_lat)
    d_lat = F.ceil(m / 111320.0 * float(E7)).cast("long")
    widest = F.greatest(F.abs(lo), F.abs(hi)) / float(E7)
    d_lon = F.ceil(m / (111320.0 * F.greatest(F.cos(F.radians(widest)), F.lit(0.01))) * float(E7)).cast("long")
    grown = (
        F.greatest(_c(min_lon) - d_lon, F.lit(WORLD[0])), F.greatest(lo - d_lat, F.lit(WORLD[1])),
        F.least(_c(max_lon) + d_lon, F.lit(WORLD[2])), F.least(hi + d_lat, F.lit(WORLD[3])),
    )
    names = ("min_lon_e7", "min_lat_e7", "max_lon_e7", "max_lat_e7")
    return {n: F.when(m.isNull(), F.lit(w)).otherwise(g).cast("long") for n, w, g in zip(names, WORLD, grown, strict=True)}


def tile_feature(zoom, x, y) -> Column:
    """The tile as GeoJSON feature text (X15), coordinates in degrees with seven decimals."""
    b = tile_bounds(zoom, x, y)
    p = lambda lon, lat: F.concat(F.lit("["), degrees_text(b[lon]), F.lit(","), degrees_text(b[lat]), F.lit("]"))
    ring = F.concat_ws(",", p("min_lon_e7", "min_lat_e7"), p("min_lon_e7", "max_lat_e7"), p("max_lon_e7", "max_lat_e7"), p("max_lon_e7", "min_lat_e7"), p("min_lon_e7", "min_lat_e7"))
    return F.concat(F.lit('{"type":"Feature","geometry":{"type":"Polygon","coordinates":[['), ring, F.lit(']]},"properties":{"shard":"'), tile_name(zoom, x, y), F.lit('"}}'))


def degrees_text(e7) -> Column:
    """An e7 integer as degrees with seven decimals, without a detour over floating point."""
    v = _c(e7)
    a = F.abs(v)
    whole = F.floor(a / E7).cast("long")
    return F.concat(F.when(v < 0, "-").otherwise(""), whole.cast("string"), F.lit("."), F.lpad((a % E7).cast("string"), 7, F.lit("0")))


def shard_path(zoom, x, y, scheme: str) -> Column:
    """Path of a tile's file by scheme name or by its pattern (K2); another scheme is an error."""
    pattern = SCHEMES.get(scheme.upper(), scheme)
    if pattern not in SCHEMES.values():
        raise ValueError(f"not a path scheme: {scheme}")
    out = F.lit(pattern)
    for token, v in (("zz", zoom), ("xx", x), ("yy", y)):
        out = F.replace(out, F.lit(token), _c(v).cast("string"))
    return out
