"""Rings by list ranking, and multipolygons."""

import random

from pyspark.sql import functions as F

from quadra.operators import rings as R

POINT = "struct<lon_e7:bigint,lat_e7:bigint>"


def lines(spark, rows):
    return spark.createDataFrame(rows, f"relation_id long, role string, geom array<{POINT}>").repartition(3)


def chained(spark, rows):
    return [(r.relation_id, r.role, r.ring and [(p.lon_e7, p.lat_e7) for p in r.ring]) for r in R.chain(lines(spark, rows)).collect()]


def canonical(ring):
    """A closed ring as its set of undirected sides."""
    return frozenset(frozenset(s) for s in zip(ring, ring[1:]))


def box(a, b, c, d):
    return [(a, b), (c, b), (c, d), (a, d), (a, b)]


def test_lines_make_rings(spark):
    rows = [(1, "outer", [(0, 0), (1, 0)]), (1, "outer", [(1, 1), (1, 0)]), (1, "outer", [(1, 1), (0, 0)]), (1, "outer", [(5, 5), (6, 5), (6, 6), (5, 5)])]
    rows += [(1, "inner", [(0, 0), (1, 0)]), (2, "outer", [(0, 0), (1, 0)]), (2, "outer", [(1, 0), (0, 0)]), (3, "outer", box(0, 0, 2, 2)), (3, "outer", [(7, 7), (8, 8)])]
    got = chained(spark, rows)
    assert {canonical(r) for k, role, r in got if k == 1 and role == "outer" and r} == {canonical([(0, 0), (1, 0), (1, 1), (0, 0)]), canonical([(5, 5), (6, 5), (6, 6), (5, 5)])}
    assert all(r[0] == r[-1] for _, _, r in got if r)
    # open lines, rings of two corners, and closed rings beside an open line
    assert sorted((k, role) for k, role, r in got if r is None) == [(1, "inner"), (2, "outer"), (3, "outer")]
    assert len(got) == 5


def test_a_coastline_in_many_pieces(spark):
    """Three rings of different lengths, dealt out in lines of random directions; one of them in 130 lines."""
    rng = random.Random(4)
    rows, want = [], []
    for k, n in enumerate((130, 37, 3)):
        corners = [(1000 * k + i, i * i % 997) for i in range(n)]
        ring = [*corners, corners[0]]
        want.append(canonical(ring))
        for p, q in zip(ring, ring[1:]):
            rows.append((7, "outer", [p, q] if rng.random() < 0.5 else [q, p]))
    rng.shuffle(rows)
    got = chained(spark, rows)
    assert sorted(map(len, (r for _, _, r in got))) == [4, 38, 131]
    assert {canonical(r) for _, _, r in got} == set(want)


def test_holes_go_to_their_outer_rings(spark):
    """Two outer rings; holes in each, one of which touches; an island in a hole with a hole of its own; a hole outside of all."""
    rows = [(1, "outer", box(0, 0, 100, 100)), (1, "outer", box(200, 0, 300, 100)), (1, "inner", box(10, 10, 60, 60)), (1, "outer", box(20, 20, 50, 50)), (1, "inner", box(30, 30, 40, 40))]
    rows += [(1, "inner", [(0, 50), (5, 80), (5, 90), (0, 50)]), (1, "inner", box(210, 10, 220, 20)), (1, "inner", box(230, 10, 240, 20)), (1, "inner", box(500, 500, 510, 510))]
    rows += [(2, "outer", box(0, 0, 1000, 1000)), (3, "inner", box(0, 0, 5, 5)), (4, "outer", box(0, 0, 5, 5)), (4, "outer", [(9, 9), (10, 10)])]
    found = R.multipolygons(R.chain(lines(spark, rows))).withColumn("area2", R.parts_area2(F.col("parts"))).collect()
    parts = {r.relation_id: {(min((p.lon_e7, p.lat_e7) for p in x.outer)): len(x.holes) for x in r.parts} for r in found}
    assert parts == {1: {(0, 0): 2, (200, 0): 2, (20, 20): 1}, 2: {(0, 0): 0}}
    area = {r.relation_id: int(r.area2) for r in found}
    assert area == {1: 2 * (10000 - 2500) - 50 + 2 * (10000 - 200) + 2 * (900 - 100), 2: 2_000_000}


def test_two_squares_and_a_hole_stay_so_when_features_are_augmented(spark):
    from quadra.operators.relations import augment, polygons

    rows = [(1, "outer", box(0, 0, 10, 10)), (1, "outer", box(20, 0, 30, 10)), (1, "inner", box(2, 2, 4, 4))]
    features = spark.createDataFrame([("RELATION", 1, None), ("AREA", 1, [(0, 0), (1, 0), (1, 1), (0, 0)])], f"item_type string, id long, geom array<{POINT}>")
    rows_of = augment(features, polygons(lines(spark, rows))).withColumn("t", R.parts_wkt(F.col("parts"))).collect()
    got = {r.item_type: r for r in rows_of}
    assert got["AREA"].parts is None and sorted(len(p.holes) for p in got["RELATION"].parts) == [0, 1]
    wkt = got["RELATION"].t
    assert wkt.startswith("MULTIPOLYGON (((0.0000000 0.0000000, ") and wkt.count("((") == 2 and wkt.count("), (") == 2
