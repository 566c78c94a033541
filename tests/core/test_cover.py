"""The cover index of polygons, and what is cut and found by it, against plain code with fractions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quadra.operators import cover as C
from quadra.plans import raw, slicing
from quadra.session import cut

POINT = "struct<lon_e7:bigint,lat_e7:bigint>"
RNG = random.Random(1)


def star(n, cx, cy, r0, r1):
    pts = []
    for i in range(n):
        r = RNG.uniform(r0, r1)
        pts.append((int(cx + math.cos(2 * math.pi * i / n) * r), int(cy + math.sin(2 * math.pi * i / n) * r)))
    return [*pts, pts[0]]


ELL = [(0, 0), (0, 300_000_000), (100_000_000, 300_000_000), (100_000_000, 100_000_000), (300_000_000, 100_000_000), (300_000_000, 0), (0, 0)]
AREAS = [
    ("A", star(600, 300_000_000, 100_000_000, 150_000_000, 200_000_000), [star(50, 300_000_000, 100_000_000, 10_000_000, 40_000_000)]),
    ("A", star(30, 900_000_000, 100_000_000, 5_000_000, 20_000_000), []),
    ("B", star(6, -300_000_000, -800_000_000, 50_000_000, 90_000_000), []),  # beyond the last row of tiles
    ("C", ELL, []),
]


@pytest.fixture(scope="module")
def areas(spark):
    rows = [(k, o, hs) for k, o, hs in AREAS]
    return spark.createDataFrame(rows, f"country string, outer array<{POINT}>, holes array<array<{POINT}>>")


@pytest.fixture(scope="module")
def index(areas):
    return cut(C.build_cover(areas))


def rings(country):
    return [r for k, o, hs in AREAS if k == country for r in (o, *hs)]


def inside(x, y, country):
    n = 0
    for r in rings(country):
        for (px, py), (qx, qy) in zip(r, r[1:]):
            n += (py > y) != (qy > y) and px + Fraction((y - py) * (qx - px), qy - py) > x
    return n % 2 == 1


def test_tiles_hold_few_edges(index):
    top = index.agg(F.max(F.size("edges")), F.count_if(F.size("edges") == 0)).first()
    assert top[0] <= C.EDGES and top[1] > 0


def test_points_are_found_as_plain_code_says(spark, index):
    """Anywhere, near the areas, on corners and on edges."""
    pts = [(RNG.randint(-1_800_000_000, 1_800_000_000), RNG.randint(-900_000_000, 900_000_000)) for _ in range(200)]
    pts += [(RNG.randint(0, 600_000_000), RNG.randint(-200_000_000, 400_000_000)) for _ in range(1500)]
    pts += [(int(RNG.gauss(-300_000_000, 70_000_000)), max(-900_000_000, int(RNG.gauss(-800_000_000, 50_000_000)))) for _ in range(300)]
    pts += [(x * 50_000_000, y * 50_000_000) for x in range(-1, 8) for y in range(-1, 8)] + [p for _, o, _ in AREAS for p in o[:60]]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id int, lon_e7 long, lat_e7 long")
    got = sorted((r.id, r.country) for r in C.locate_in(df, index).collect())
    assert got == sorted((i, k) for i, (x, y) in enumerate(pts) for k in "ABC" if inside(x, y, k))
    plan = C.locate_in(df, index)._jdf.queryExecution().executedPlan().toString()
    assert "outer" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def pieces(way, country):
    """Points of each piece of a way inside a country; for ways without a corner on a border."""
    out, now = [], None
    for i, p in enumerate(way):
        if inside(*p, country):
            now = now or []
            now.append(p)
        if i + 1 == len(way):
            break
        q, hits = way[i + 1], []
        for r in rings(country):
            for a, b in zip(r, r[1:]):
                s, t = ((b[0] - a[0]) * (v[1] - a[1]) - (b[1] - a[1]) * (v[0] - a[0]) for v in (p, q))
                u, v = ((q[0] - p[0]) * (c[1] - p[1]) - (q[1] - p[1]) * (c[0] - p[0]) for c in (a, b))
                if (s > 0) != (t > 0) and (u > 0) != (v > 0):
                    hits.append(Fraction(s, s - t))
        for t in sorted(hits):
            at = tuple(math.floor(p[k] + t * (q[k] - p[k])) for k in (0, 1))
            if now is None:
                now = [at]
            else:
                out.append([*now, at])
                now = None
    return out + ([now] if now else [])


def test_ways_are_cut_as_plain_code_says(spark, areas):
    ways = {w: [(RNG.randint(0, 500_000_000), RNG.randint(-100_000_000, 350_000_000)) for _ in range(RNG.randint(2, 5))] for w in range(40)}
    ways[40] = [(-50_000_000, 50_000_001), (350_000_000, 50_000_001), (50_000_001, 50_000_001)]  # there and back
    df = spark.createDataFrame([(w, i + 1, *p) for w, ps in ways.items() for i, p in enumerate(ps)], "way_id long, seq int, lon_e7 long, lat_e7 long")
    got = slicing.slice_lines(df, areas).collect()
    for k in "AC":
        mine = sorted((r.way_id, [tuple(p) for p in r.geom]) for r in got if r.country == k)
        assert mine == sorted((w, p) for w, ps in ways.items() for p in pieces(ps, k))
    for w in ways:
        assert sorted(r.piece for r in got if r.way_id == w) == list(range(1, sum(r.way_id == w for r in got) + 1))


def test_a_way_on_and_across_borders(spark, areas):
    """It runs along the L's lower border, which is inside, along its right one, which is not, and touches a corner from outside."""
    m = 1_000_000
    ways = {1: [(10 * m, 0), (20 * m, 0)], 2: [(300 * m, 10 * m), (300 * m, 20 * m)], 3: [(50 * m, 350 * m), (150 * m, 250 * m)], 4: [(-10 * m, 10 * m), (0, 0), (-10 * m, -10 * m)], 5: [(-10 * m, 200 * m), (200 * m, 200 * m)]}
    df = spark.createDataFrame([(w, i + 1, *p) for w, ps in ways.items() for i, p in enumerate(ps)], "way_id long, seq int, lon_e7 long, lat_e7 long")
    got = {r.way_id: [tuple(p) for p in r.geom] for r in slicing.slice_lines(df, areas.where("country = 'C'")).collect()}
    assert got == {1: [(10 * m, 0), (20 * m, 0)], 5: [(0, 200 * m), (100 * m, 200 * m)]}


def test_completion_ends_and_reaches_every_depth(spark):
    nodes = spark.createDataFrame([(1, 1, 0, 0), (2, 1, 90, 90), (3, 1, 95, 95), (3, 2, 1, 1), (4, 1, 0, 0), (4, 2, 99, 99)], "node_id long, version int, lon_e7 long, lat_e7 long")
    ways = spark.createDataFrame([(1, 1, [1, 2, 77]), (2, 1, [2, 4]), (3, 1, [2]), (3, 5, [2, 3])], "way_id long, version int, nodes array<long>")
    members = [(1, 1, 1, "WAY", 1, ""), (2, 1, 1, "RELATION", 1, ""), (3, 1, 1, "RELATION", 2, ""), (1, 1, 2, "RELATION", 3, ""), (4, 1, 1, "WAY", 2, ""), (5, 1, 1, "NODE", 3, ""), (6, 1, 1, "WAY", 1, ""), (6, 2, 1, "WAY", 2, "")]
    m = spark.createDataFrame(members, "relation_id long, version int, seq int, member_type string, member_id long, role string")
    box = dict(zip(("min_lon_e7", "min_lat_e7", "max_lon_e7", "max_lat_e7"), (0, 0, 10, 10)))
    got = raw.complete([nodes], [ways, ways], [m, m], box)
    assert sorted((r.node_id, r.version) for r in got["nodes"].collect()) == [(1, 1), (2, 1), (3, 2)]
    assert sorted((r.way_id, r.version) for r in got["ways"].collect()) == [(1, 1), (3, 5)]
    assert sorted((r.relation_id, r.seq) for r in got["members"].collect()) == [(1, 1), (1, 2), (2, 1), (3, 1), (5, 1)]


def test_leaf_of_a_point_on_a_border(spark):
    """A leaf is its box with the lower and left border, also at the equator, where the tile's number goes by the upper one."""
    from quadra.functions.tiles import tile_bounds
    from quadra.operators.spatial import leaves_holding

    leaves = spark.createDataFrame([(1, x, y) for x in (0, 1) for y in (0, 1)], "zoom int, x long, y long").withColumns(tile_bounds("zoom", "x", "y"))
    points = spark.createDataFrame([(1, 0, 0), (2, -1, 0), (3, 0, -1), (4, -1, -1), (5, 1_800_000_000, 890_000_000)], "id int, lon_e7 long, lat_e7 long")
    got = {r.id: (r.x, r.y) for r in leaves_holding(points, leaves).collect()}
    assert got == {1: (1, 0), 2: (0, 0), 3: (1, 1), 4: (0, 1), 5: (1, 0)}


def test_sides_are_found_without_decimals(spark):
    """The sign of the cross product at the ends of the world, where the difference of its two products does not fit."""
    from quadra.operators.cover import side, turns

    ends = [(x, y) for x in (-1_800_000_000, 0, 1_800_000_000) for y in (-900_000_000, 1, 900_000_000)]
    pairs = [(a, b, c) for a in ends for b in ends for c in ends]
    df = spark.createDataFrame([(*a, *b, *c) for a, b, c in pairs], "px long, py long, qx long, qy long, x long, y long")
    p = {k: F.col(k) for k in ("px", "py", "qx", "qy")}
    got = [r.s for r in df.select(side(p["qx"] - p["px"], p["qy"] - p["py"], F.col("x") - p["px"], F.col("y") - p["py"]).alias("s")).collect()]
    of = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    assert got == [(v > 0) - (v < 0) for v in (of(*t) for t in pairs)] and set(got) == {-1, 0, 1}
    plan = df.select(turns(p, F.col("x"), F.col("y"), F.lit(5), F.lit(5)))._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan


def test_wide_borders_meet_segments_in_small_tiles(spark, sf):
    from quadra import tables as T

    tiles = {r.z for r in slicing._border(C.build_cover(T.outlines(spark, sf)), "country").select(F.col("t.zoom").alias("z")).collect()}
    assert tiles and min(tiles) >= slicing.FINE
