import pytest
from pyspark.sql import functions as F

from quadra.operators import changes as C
from quadra.operators import snapshots
from quadra.plans import levels
from quadra.plans.levels import Mutation


def view(**kw):
    base = {"country": "A", "shard": "1-0-0", "item_type": "EDGE", "id": 100, "change_type": "ADD", "full": False, "geom": None, "tags": None, "start_node": None, "end_node": None, "mutation": "m", "source_shard": "1-0-0", "level": 0}
    return {**base, **dict.fromkeys(C.BOX, 0), **kw}


def test_lower_node_id():
    left = view(full=True, start_node=50, end_node=51, tags={"a": "b"})
    got = C.lower_node_id(left, view(end_node=5))
    assert (got["id"], got["start_node"], got["end_node"], got["tags"]) == (100, 50, 5, {"a": "b"})
    with pytest.raises(ValueError):
        C.lower_node_id(left, view(change_type="REMOVE"))
    with pytest.raises(ValueError):
        C.lower_node_id(left, view(id=101))


def test_remove_over_add_and_left():
    add, gone = view(), view(change_type="REMOVE", full=True)
    assert C.remove_over_add(add, gone) is gone and C.remove_over_add(gone, add) is gone and C.always_left(add, gone) is add
    with pytest.raises(ValueError):
        C.remove_over_add(add, add)
    with pytest.raises(ValueError):
        C.remove_over_add(add, view(id=7, change_type="REMOVE"))


def test_prioritize_tag():
    a, b = view(tags={"x": "1"}), view(tags={"y": "1", "x": "2"})
    assert C.prioritize_tag([("y", "*", True)])(a, b) is b
    assert C.prioritize_tag([("x", "*", True), ("x", "1", True)])(a, b) is a
    assert C.prioritize_tag([("x", "*", False)])(a, b) is a
    with pytest.raises(ValueError):
        C.prioritize_tag([("x", "*", True)])(a, b)


def test_fold_order_and_conflicts():
    tags = lambda v: view(tags={"k": v})
    policy = C.MergePolicy(root={"TAGS": lambda l, r: view(tags={"k": f"({l['tags']['k']}{r['tags']['k']})"})})
    assert C.fold([tags("a"), tags("b"), tags("c")], policy)["tags"] == {"k": "(c(ab))"}
    with pytest.raises(ValueError, match="cannot be merged"):
        C.fold([tags("a"), tags("b")], C.MergePolicy())
    assert C.fold([view(tags={"a": "1"}), view(tags={"b": "2"}, full=True)], C.MergePolicy())["tags"] == {"a": "1", "b": "2"}
    exact = C.MergePolicy(exact={("MERGE", "TAGS"): C.always_left}, part={("MERGE",): lambda l, r: r})
    assert exact.strategy(("MERGE", "TAGS")) is C.always_left and exact.strategy(("MERGE", "GEOM"))(1, 2) == 2


def test_conflict_without_policy_is_an_error(spark, sf):
    from quadra.catalog.edits import sharded

    made = levels.self_conflicting(F.col("item_type") == "AREA").run(sharded(spark, sf), None)
    with pytest.raises(Exception, match="cannot be merged"):
        C.merge(made).count()


def test_level_order():
    m = lambda n, *d, **k: Mutation(n, lambda f, c: f, d, **k)
    got = levels.order_levels([m("c", "b"), m("b", "a", "ghost"), m("a"), m("d", "off"), m("off", enabled=False)])
    assert [[x.name for x in level] for level in got] == [["a", "d"], ["b"], ["c"]]
    with pytest.raises(ValueError, match="depend on each other"):
        levels.order_levels([m("a", "b"), m("b", "a")])
    assert levels.order_levels([]) == []


def test_equal_snapshots_have_no_difference(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 3)], "id int, x string, y int")
    assert snapshots.diff(df, df, ["id"], ["x", "y"]).count() == 0
    got = snapshots.diff(df, df.where("id = 1").unionByName(spark.createDataFrame([(2, "b", 3), (9, "n", 1)], df.schema)), ["id"], ["x", "y"])
    assert sorted((r.id, r.kind) for r in got.collect()) == [(2, "CHANGED"), (9, "ADDED")]


def test_country_lists(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "country string")
    assert [r.country for r in snapshots.countries(df, ["A", "B"], ["C"]).collect()] == ["A", "B"]
    assert [r.country for r in snapshots.countries(df, None, ["C"]).collect()] == ["A", "B"]
    with pytest.raises(ValueError):
        snapshots.countries(df, ["A"], ["A"])


def test_new_nodes_of_foreign_shards_vanish(spark):
    rows = [("A", "1-0-0", "NODE", 1, "ADD", "1-0-0"), ("A", "1-0-0", "NODE", 2, "ADD", "1-1-0"), ("A", "1-0-0", "NODE", 3, "ADD", None)]
    ch = spark.createDataFrame(rows, "country string, shard string, item_type string, id long, change_type string, source_shard string")
    edges = spark.createDataFrame([], "start_node long, end_node long, geom array<struct<lon_e7:bigint,lat_e7:bigint>>")
    boxes = spark.createDataFrame([("A", "1-0-0", 0, 0, 10, 10)], "country string, shard string, min_lon_e7 long, min_lat_e7 long, max_lon_e7 long, max_lat_e7 long")
    assert sorted(r.id for r in C.own_nodes(ch, edges, boxes).collect()) == [1, 3]


def test_assigned_once(spark):
    """A change that three shards made alike comes to each shard once, and the same as after assigning each and merging."""
    from quadra.operators import changes as C

    box = ", ".join(f"{c} long" for c in C.BOX)
    shards = spark.createDataFrame([("N01", f"14-{i}-0", i * 100, 0, i * 100 + 100, 100) for i in range(5)], f"country string, shard string, {box}")
    rows = [("N01", f"14-{i}-0", "LINE", 7, None, {"b": "1", "a": "2"}, None, None, 50, 10, 350, 20) for i in range(3)]
    f = spark.createDataFrame(rows, f"country string, shard string, item_type string, id long, geom {C.POINTS}, tags map<string,string>, start_node long, end_node long, {box}")
    made = C.change(f, "ADD", "m")
    once = C.assign_once(made, shards)
    flat = lambda df: sorted((r.shard, r.source_shard, sorted(r.tags.items()), r.full) for r in df.collect())
    assert once.count() == 4 and C.assign(made, shards).count() == 12
    assert flat(once) == flat(C.merge(C.assign(made, shards)))


def test_cells_join_like_boxes(spark):
    """Many boxes of all sizes, on and beside tile borders, against leaves of all levels."""
    from quadra.functions.tiles import tile_bounds
    from quadra.operators.changes import BOX
    from quadra.operators.spatial import join_boxes, join_cells

    from pyspark.sql import functions as F

    leaves = spark.createDataFrame([(z, x, y) for z in (1, 3, 6, 11, 14) for x in range(2 ** (z - 1) - 1, 2 ** (z - 1) + 1) for y in range(2 ** (z - 1) - 1, 2 ** (z - 1) + 1)], "zoom int, x long, y long").withColumns(tile_bounds("zoom", "x", "y"))
    edges = [-1_800_000_000, -7_031_250, -219_727, -219_726, -1, 0, 1, 219_726, 219_727, 7_031_250, 1_800_000_000]
    spans = [(a, b) for a in edges for b in edges if a <= b]
    some = [(i, x[0], max(-850_000_000, y[0]), x[1], min(850_000_000, y[1])) for i, (x, y) in enumerate((x, y) for x in spans for y in spans)][::7]
    boxes = spark.createDataFrame(some, "id int, " + ", ".join(f"{c} long" for c in BOX))
    key = lambda df: df.select("a_id", F.concat_ws("-", "b_zoom", "b_x", "b_y").alias("leaf"))
    want, got = key(join_boxes(boxes, leaves)), key(join_cells(boxes, leaves))
    assert want.count() == got.count() > 0 and want.exceptAll(got).count() == 0
