"""What the map queries derive and deal once: ways, sections, edges with their reverses."""

import os

from pyspark.sql import functions as F

from quadra import tables as T
from quadra.catalog import edits
from quadra.plans import build
from quadra.session import shared_dir


def _stored(spark):
    path = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    return {n.rsplit("-", 1)[0] for n in os.listdir(path)} if os.path.isdir(path) else set()


def test_ways_are_cut_as_their_points_are(spark):
    """A ring that passes its start, a way passed by another, and one with the same node twice in a row of three."""
    nodes = [(1, [10, 11, 12, 10]), (2, [20, 11, 21]), (3, [30, 31]), (4, [40, 41, 40, 42])]
    ways = spark.createDataFrame([(w, n, [(i * 10, i) for i in n], {"highway": "x"}) for w, n in nodes], "way_id long, nodes array<long>, geom array<struct<lon_e7:long,lat_e7:long>>, tags map<string,string>")
    points = ways.select("way_id", F.posexplode("nodes").alias("at", "node_id")).select("way_id", (F.col("at") + 1).alias("seq"), "node_id", (F.col("node_id") * 10).alias("lon_e7"), F.col("node_id").alias("lat_e7"))
    rows = lambda df: sorted((r.way_id, r.section, r.start_node, r.end_node, [tuple(p) for p in r.geom]) for r in df.collect())
    assert rows(build.sections_of(ways)) == rows(build.sections(points))


def test_reverse_edges_are_turned(spark):
    parts = spark.createDataFrame([(1, 1, 5, 6, [(0, 0), (10, 20)], {"oneway": "yes"}), (2, 1, 7, 8, [(0, 0), (30, 5)], {"oneway": "no"})], "way_id long, section int, start_node long, end_node long, geom array<struct<lon_e7:long,lat_e7:long>>, tags map<string,string>")
    got = {r.id: (r.start_node, r.end_node, [tuple(p) for p in r.geom], r.max_lon_e7) for r in build.edges(parts).collect()}
    assert got == {1000001: (5, 6, [(0, 0), (10, 20)], 10), 2000001: (7, 8, [(0, 0), (30, 5)], 30), -2000001: (8, 7, [(30, 5), (0, 0)], 30)}


def test_edge_queries_store_ways_and_sections_once(spark, sf):
    """Neither points, nodes nor directed edges are stored for them."""
    before = _stored(spark)
    edits.QUERIES["p20_for_log"](spark, sf).count()
    assert {"drawn", "road_sections"} <= _stored(spark)
    assert not (_stored(spark) - before) & {"way_nodes", "nodes", "edges", "ways", "sharded_edges"}


def test_reverse_edges_travel_with_their_edge(spark, sf):
    """Directions are told apart after the tiles are joined: above all joins of the plan."""
    plan = edits.sharded_edges(spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda word: min(len(line) - len(line.lstrip(" :+-")) for line in plan if word in line)
    assert depth("__way") < depth("Join")


def test_tree_counts_tiles_once(spark, sf):
    plan = T.build_tree(T.nodes(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


def test_items_travel_with_their_number_and_part_alone(spark, sf):
    """Items that are equal in both are one place; the other columns do not order them, and what is stored has no points."""
    import tempfile

    d = tempfile.mkdtemp()
    items = [(1, 1, 5, 9), (1, 1, 5, 3), (1, 2, 69, 1), (1, 3, 7, 1), (1, 4, 5, 1), (2, 1, 64, 1)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(1, 3, "2-HIGH", "F"), (2, 3, "1-URGENT", "O")], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string").write.parquet(f"{d}/orders.parquet")
    assert sorted((r.way_id, r.seq, r.node_id) for r in T.way_nodes(spark, d).collect()) == [(1, 1, 197), (1, 2, 199), (1, 3, 197), (2, 1, 192)]
    assert set(T.drawn(spark, d).columns) == {"way_id", "cust", "rank", "oneway", "k"}


def test_tree_of_places_is_that_of_nodes(spark, sf):
    want, got = T.build_tree(T.nodes(spark, sf)), T.build_tree(T.places(spark, sf), of=F.col("n"))
    assert want.count() == got.count() and want.exceptAll(got).count() == 0


def test_ways_travel_without_their_line(spark, sf):
    """Roads are drawn after the join with their junctions."""
    plan = build.sections_of(T.roads(spark, sf), T.lines_of)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda word: min(len(line) - len(line.lstrip(" :+-")) for line in plan if word in line)
    assert depth("lon_e7") < depth("Join LeftOuter")


def test_cells_and_boxes_meet_by_numbers(spark):
    """What the cells and the leaves are joined by has neither boxes nor names; each pair is found once."""
    from quadra.functions.tiles import tile_bounds
    from quadra.operators import spatial

    leaves = spark.createDataFrame([(z, x, y) for z in (2, 5, 9) for x in range(4) for y in range(4)], "zoom int, x long, y long").withColumns(tile_bounds("zoom", "x", "y"))
    placed = spatial._placed(leaves.select(*[F.col(c).alias("b_" + c) for c in ("min_lon_e7", "min_lat_e7", "max_lon_e7", "max_lat_e7")]), "b_").withColumn("__b", F.monotonically_increasing_id()).localCheckpoint()
    cells = spark.createDataFrame([(z, x, y) for z in (0, 3, 5, 8, 11) for x in range(8 if z else 1) for y in range(8 if z else 1)], "z int, x int, y int").select(spatial._number("z", "x", "y").alias("cell"))
    near = spatial._near(cells, placed)
    got = {(r.cell, r["__b"]) for r in near.collect()}
    want = set()
    for b in placed.collect():
        for r in cells.collect():
            s, x, y = 14 - (r.cell >> 40), r.cell >> 20 & 1048575, r.cell & 1048575
            if x <= b.b_tx1 >> s and x >= b.b_tx0 >> s and y <= b.b_ty1 >> s and y >= b.b_ty0 >> s:
                want.add((r.cell, b["__b"]))
    assert got == want and near.count() == len(got) > 0
    assert near.columns == ["cell", "__b"]
