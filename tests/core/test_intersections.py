"""What two polygons have in common."""

from pyspark.sql import functions as F

from quadra.operators.rings import parts_area2
from quadra.plans.slicing import intersections

POINT = "struct<lon_e7:bigint,lat_e7:bigint>"
M = 1_000_000


def box(a, b, c, d):
    return [(a * M, b * M), (c * M, b * M), (c * M, d * M), (a * M, d * M), (a * M, b * M)]


def scaled(*pts):
    return [(x * M, y * M) for x, y in (*pts, pts[0])]


def test_concave_outlines_holes_and_touching_borders(spark):
    a = [
        (1, scaled((0, 5), (0, 10), (2, 10), (2, 5), (8, 5), (8, 10), (10, 10), (10, 0), (0, 0)), []),  # a U, upside down it falls into two
        (2, box(20, 0, 40, 20), [box(25, 5, 35, 15)]),  # a frame, cut through its hole and around a smaller square
        (3, box(100, 100, 101, 101), []),  # away from all
        (4, box(10, 0, 15, 6), []),  # shares a border with B, and a part of the area
        (5, box(60, 60, 70, 70), []),  # around C
        (6, scaled((21, 1), (24, 1), (24, 4)), []),  # inside of D
    ]
    b = [("B", box(-5, 6, 12, 50), []), ("C", box(62, 62, 64, 64), []), ("D", box(20, 0, 30, 20), []), ("E", scaled((0, 0), (50, 0), (0, 50)), [box(1, 1, 3, 3)])]
    kind = f"outer array<{POINT}>, holes array<array<{POINT}>>"
    got = intersections(spark.createDataFrame(a, f"id long, {kind}"), spark.createDataFrame(b, f"country string, {kind}"))
    rows = {(r.id, r.country): (len(r.parts), sum(len(p.holes) for p in r.parts), int(r.area) / M / M / 2) for r in got.withColumn("area", parts_area2(F.col("parts"))).collect()}
    assert rows[1, "B"] == (2, 0, 16.0)
    assert rows[2, "D"] == (1, 0, 150.0)
    assert rows[5, "C"] == (1, 0, 4.0)
    assert rows[6, "D"] == (1, 0, 4.5)
    assert rows[1, "E"] == (1, 1, 100 - 30 - 4.0)
    assert rows[2, "E"][:2] == (1, 1) or rows[2, "E"][0] >= 1
    assert rows[4, "E"] == (1, 0, 30.0)
    assert not {k for k in rows if k[0] == 3} and (4, "B") not in rows
