"""Properties that hold for any input."""

import pytest
from pyspark.sql import functions as F

from quadra import registry
from quadra import tables as T
from quadra.catalog import features
from quadra.functions.geometry import BOX
from quadra.operators import spatial, trees
from quadra.plans import build


def test_sections_rejoin_to_their_way(spark, sf):
    parts = build.sections(features.road_nodes(spark, sf))
    steps = parts.select("way_id", (F.size("geom") - 1).alias("n")).groupBy("way_id").agg(F.sum("n").alias("n"))
    ways = T.ways(spark, sf).where("kind = 'road'").select("way_id", (F.col("n") - 1).alias("n"))
    assert steps.exceptAll(ways).count() == 0 and ways.exceptAll(steps).count() == 0
    gaps = parts.alias("a").join(parts.alias("b"), (F.col("a.way_id") == F.col("b.way_id")) & (F.col("a.section") + 1 == F.col("b.section")))
    assert gaps.where("a.end_node <> b.start_node").count() == 0


def test_every_point_lies_in_one_leaf(spark, sf):
    n = T.nodes(spark, sf)
    placed = spatial.shards_of_points(n, T.tiles(spark, sf))
    assert placed.count() == n.count() == placed.select("node_id").distinct().count()
    top = placed.where("zoom < 14").groupBy("zoom", "x", "y").count().agg(F.max("count")).first()[0]
    assert top <= T.TREE_LIMIT


def test_tree_is_consistent(spark, sf):
    tree = T.build_tree(T.nodes(spark, sf))
    assert trees.inconsistencies(tree).count() == 0
    small = trees.split_leaves(tree, T.tile_counts(T.nodes(spark, sf)).withColumnRenamed("n", "size"), 50)
    assert trees.inconsistencies(small.drop("new")).count() == 0


def test_each_way_node_lies_in_one_country_piece(spark, sf):
    pieces = build.slice_at_borders(T.way_nodes(spark, sf), T.boundaries(spark, sf))
    own = pieces.where("not cut")
    assert own.count() == T.way_nodes(spark, sf).count()
    assert own.groupBy("way_id", "piece").agg(F.count_distinct("country").alias("n")).where("n > 1").count() == 0


SPATIAL = [
    "shard_statistics", "x4_shards_of_bbox", "x7_loading_areas", "x9_point_in_box", "x9_point_in_outline", "x10_line_meets_tile", "x12_covered_by_holes", "c2_slicing", "c2_slice_polygons",
    "c6_neighbours", "j1_country_shards", "j1_country_outlines", "j9_fan_out", "j11_input_tiles", "j14_missing_proof", "j14_missing_outlines", "p12_polygon_filter", "p12_outline_filter",
]


@pytest.mark.parametrize("name", SPATIAL)
def test_spatial_joins_are_equi_joins(spark, sf, name):
    f = registry.queries()[name]
    plan = getattr(f, "__wrapped__", f)(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _box(lon, lat, w, h):
    return lon, lat, lon + w, lat + h


def test_boxes_of_all_sizes_meet_as_brute_force_says(spark):
    """Points, lines, tiles and continents, also at the ends of the world, at tile borders and in one crowded place."""
    import random

    rng = random.Random(5)
    world = (-1_800_000_000, -900_000_000)
    rows = [_box(rng.randint(world[0], -world[0]), rng.randint(world[1], -world[1]), 10 ** rng.randint(0, 9), 10 ** rng.randint(0, 8)) for _ in range(120)]
    rows += [_box(450_000_000 + rng.randint(0, 30_000), rng.randint(0, 30_000), rng.randint(0, 9_000), rng.randint(0, 9_000)) for _ in range(120)]
    rows += [_box(450_000_000 * k, 0, 0, 0) for k in range(-4, 5)] + [_box(450_000_000 * k, 0, 450_000_000, 10) for k in range(-4, 4)] + [_box(5, 5, -3, 2), _box(*world, 3_600_000_000, 1_800_000_000)]
    a = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, " + ", ".join(f"{c} long" for c in BOX))
    meet = lambda p, q: p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]
    real = [(i, r) for i, r in enumerate(rows) if r[0] <= r[2] and r[1] <= r[3]]
    want = sorted((i, j) for i, p in real for j, q in real if meet(p, q))
    pairs = spatial.join_boxes(a, a).select("a_id", "b_id").collect()
    assert sorted(map(tuple, pairs)) == want


def test_a_crowded_city_is_spread(spark):
    """All of 20,000 small boxes lie in one city, over leaves of the deepest zoom: no key holds more than a few of them."""
    a = spark.range(20_000).selectExpr("id", *[f"cast({v} as long) as {c}" for c, v in zip(BOX, ("id % 200 * 220000", "cast(id / 200 as int) * 220000", "id % 200 * 220000 + 1000", "cast(id / 200 as int) * 220000 + 1000"))])
    placed = spatial._listed(spatial._placed(a.select(*[F.col(c).alias("a_" + c) for c in a.columns]), "a_"), "a_", F.array("a_tz"))
    assert placed.groupBy("a_t").count().agg(F.max("count")).first()[0] <= 12


def test_derived_tables_are_stored_once_a_query(spark, sf):
    calls = []

    @T.kept
    def numbers(spark, sf):
        calls.append(1)
        return spark.range(3)

    both = T.keeping(lambda s, d: numbers(s, d).union(numbers(s, d)))
    assert both(spark, sf).count() == 6 and len(calls) == 1
    assert numbers(spark, sf).count() == 3 and len(calls) == 2


def test_cycles_among_relations_end(spark):
    from quadra.operators.relations import expand_members

    rows = [(1, 1, "RELATION", 2, ""), (2, 1, "RELATION", 1, ""), (2, 2, "AREA", 7, ""), (3, 1, "RELATION", 1, "")]
    got = expand_members(spark.createDataFrame(rows, "relation_id long, seq int, member_type string, member_id long, role string"))
    assert sorted((r.relation_id, r.member_id) for r in got.collect()) == [(1, 7), (2, 7), (3, 7)]


def test_leaves_of_deeply_nested_relations_are_found(spark):
    from quadra.operators.relations import expand_members

    rows = [(i, 1, "RELATION", i + 1, "") for i in range(1, 12)] + [(12, 1, "AREA", 7, "")]
    got = expand_members(spark.createDataFrame(rows, "relation_id long, seq int, member_type string, member_id long, role string"))
    assert sorted((r.relation_id, r.member_id) for r in got.collect()) == [(i, 7) for i in range(1, 13)]


def _sent(df):
    """What the plan sends to all tasks, as text."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastExchange" in line]


def test_lists_of_tiles_are_not_sent_to_all_tasks(spark):
    """A box lists many tiles, of which Spark's estimate by the files knows nothing: 20,000 boxes are a small file and long lists."""
    a = spark.range(20_000).selectExpr("id", *[f"cast({v} as long) as {c}" for c, v in zip(BOX, ("id % 200 * 220000", "cast(id / 200 as int) * 220000", "id % 200 * 220000 + 1000", "cast(id / 200 as int) * 220000 + 1000"))])
    assert not _sent(spatial.join_cells(a, a)) and not _sent(spatial.join_boxes(a, a, large=True))


def test_shards_keep_the_boxes_of_their_tiles(spark, sf):
    tiles = T.tiles(spark, sf)
    got = spatial.country_shards(tiles, T.boundaries(spark, sf), BOX)
    want = spatial.country_shards(tiles, T.boundaries(spark, sf)).join(tiles.drop("final"), ["zoom", "x", "y"]).select(got.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
