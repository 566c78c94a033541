"""What is done where rows are: shapes tested without their shards' table, files written without a shuffle, lookups by keys alone."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quadra.catalog import edits, files
from quadra.functions.geometry import BOX, POINTS, box_columns, polyline_meets_box
from quadra.operators import changes as C
from quadra.operators import spatial
from quadra.session import shared_dir
from quadra.sources import readers, writers

BOXED = ", ".join(f"{c} long" for c in BOX)


def _stored(spark):
    path = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def _made_by(spark, sf, name):
    before = _stored(spark)
    edits.QUERIES[name](spark, sf).count()
    return {n.rsplit("-", 1)[0] for n in _stored(spark) - before}


def _meets(line, box):
    west, south, east, north = box
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        sides = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x in (west, east) for y in (south, north)]
        if min(ax, bx) <= east and max(ax, bx) >= west and min(ay, by) <= north and max(ay, by) >= south and min(sides) <= 0 <= max(sides):
            return True
    return False


def test_polylines_against_whole_numbers(spark):
    """Small grids, where lines pass through corners and along sides, and the ends of the world, where a difference of two products would not fit."""
    rng, rows = random.Random(7), []
    for i in range(1500):
        lon, lat = ((0, 6), (0, 6)) if i % 3 else ((-1_800_000_000, 1_800_000_000), (-900_000_000, 900_000_000))
        at = lambda: (rng.randint(*lon), rng.randint(*lat)) if i % 2 else (rng.choice(lon), rng.choice(lat))  # noqa: B023, E731
        (a, b), (c, d) = at(), at()
        rows.append((i, [at() for _ in range(rng.randint(2, 4))], min(a, c), min(b, d), max(a, c), max(b, d)))
    df = spark.createDataFrame(rows, f"i int, geom {POINTS}, {BOXED}")
    got = {r.i: r.m for r in df.select("i", polyline_meets_box(F.col("geom"), box_columns()).alias("m")).collect()}
    want = {i: _meets(line, box) for i, line, *box in rows}
    assert got == want and 100 < sum(want.values()) < 1400
    assert "decimal" not in df.select(polyline_meets_box(F.col("geom"), box_columns()))._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["p15_overlapping_edges", "c7_generated_removes", "u5_with_removes", "p18_own_nodes", "p22_mutation_tags", "p28_include_lists"])
def test_pairs_are_not_stored(spark, sf, name):
    assert not _made_by(spark, sf, name) & {"boxes", "sharded_edges", "ids"}


@pytest.mark.parametrize("name", ["c9_apply", "j5_changes_with_groups"])
def test_sharded_features_are_not_stored(spark, sf, name):
    assert not _made_by(spark, sf, name) & {"boxes", "sharded"}


def test_box_of_a_tile_is_in_its_name(spark, sf):
    named = C.in_shard(edits.boxes(spark, sf).select("country", "shard"), None)
    same = edits.boxes(spark, sf).select("country", "shard", *[F.col(c).alias("s_" + c) for c in BOX])
    assert named.count() > 0 and named.exceptAll(same).count() == 0


def test_members_are_dealt_to_shards(spark):
    """A relation meets those shards only that a member meets, however large its own box is."""
    shards = spark.createDataFrame([("A", f"14-{i}-0", i * 1000, 0, i * 1000 + 900, 900) for i in range(20)], f"country string, shard string, {BOXED}")
    leaves = spark.createDataFrame([(1, "AREA", 5), (1, "AREA", 6), (2, "AREA", 6)], "relation_id long, member_type string, member_id long")
    shapes = spark.createDataFrame([("AREA", 5, 100, 0, 200, 9), ("AREA", 6, 18_950, 0, 19_000, 9)], f"member_type string, member_id long, {BOXED}")
    assert sorted((r.id, r.shard) for r in C._met(leaves, shapes, shards).collect()) == [(1, "14-0-0"), (1, "14-19-0"), (2, "14-19-0")]


def test_first_country_without_another_shuffle(spark):
    req = spark.createDataFrame([("A", "s", "s"), ("B", "s", "s")], "country string, origin string, neighbour string")
    f = spark.createDataFrame([("B", "s", "AREA", 1), ("C", "s", "AREA", 1), ("C", "s", "AREA", 2)], "country string, shard string, item_type string, id long")
    out = spatial.fetch_all_countries(req, f.hint("shuffle_merge"))
    assert sorted((r.for_country, r.id, r.country) for r in out.collect()) == [("A", 1, "B"), ("A", 2, "C"), ("B", 1, "B"), ("B", 2, "C")]
    assert out._jdf.queryExecution().sparkPlan().toString().count("Join") == 1


def _features(spark):
    rows = [("N01", f"9-{x}-{y}", "POINT", x * 16 + y, [(x, y)], {"amenity": 'a "b"'}) for x in range(16) for y in range(16)]
    return spark.createDataFrame(rows, f"country string, shard string, item_type string, id long, geom {POINTS}, tags map<string,string>")


@pytest.mark.parametrize("write", [writers.write_ldgeojson, writers.write_geojson])
def test_geojson_of_many_shards_is_in_few_folders(spark, tmp_path, write):
    f = _features(spark)
    folders = lambda path: sum(n.startswith(("block=", "shard=")) for _, names, _ in os.walk(path) for n in names)
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    write(f, few)
    write(f, many, folders=True)
    assert (folders(few), folders(many)) == (1, 256)
    rows = lambda df: sorted((r.country, r.shard, r.value) for r in df.select("country", "shard", "value").collect())
    got = rows(readers.read_named(spark.read.text(few)))
    assert len(got) == 256 and got == rows(spark.read.text(many))


def test_change_log_of_many_shards_is_in_few_folders(spark, tmp_path):
    ch = _features(spark).withColumns({"change_type": F.lit("ADD"), "mutation": F.when(F.col("id") % 2 == 0, "edit"), "source_shard": F.lit('9-"0"'), "level": F.lit(0)})
    folders = lambda path: sum(n.startswith(("block=", "shard=")) for _, names, _ in os.walk(path) for n in names)
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    writers.write_change_log({"applied": ch}, few, "APPLIED")
    writers.write_change_log({"applied": ch}, many, "APPLIED", folders=True)
    assert (folders(few), folders(many)) == (1, 128)
    rows = lambda df: sorted((r.log, r.shard, r.value) for r in df.select("log", "shard", "value").collect())
    got = rows(readers.read_named(spark.read.text(few)))
    assert len(got) == 128 and got == rows(spark.read.text(many)) and '"featureChangeType":"ADD","mutator":"edit:9-' in got[0][2]


def test_files_of_shared_folders_name_their_shards(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(writers, "write_shards", lambda df, path, scheme=None, folders=False, f=writers.write_shards: (seen.append(folders), f(df, path, scheme, folders)))
    assert files.QUERIES["s10_files"](spark, sf).count() > 0 and seen == [False]


def test_outputs_are_written_by_many_tasks(spark, tmp_path):
    """One value holds all rows: it is not brought to one task."""
    df = spark.range(0, 4000, 1, 4)
    writers.split_write(df, str(tmp_path / "a"), F.lit("x"))
    assert len([n for n in os.listdir(tmp_path / "a" / "part=x") if n.endswith(".parquet")]) == 4


@pytest.mark.parametrize("name", ["f4_lower_node", "p14_known_or_full", "p26_backfill"])
def test_edges_of_shards_are_not_stored(spark, sf, name):
    assert not _made_by(spark, sf, name) & {"sharded_edges"}


def _sharded(spark, rows):
    """(shard, id, points) as sharded lines, and the changes that add them."""
    f = spark.createDataFrame([("A", s, "LINE", i, g, {"k": str(i)}, None, None, 0, 0, 9, 9) for s, i, g in rows], f"country string, shard string, item_type string, id long, geom {POINTS}, tags map<string,string>, start_node long, end_node long, {BOXED}")
    return f, C.change(f, "ADD", "m")


def test_changes_of_a_feature_are_made_in_one_pass(spark):
    f, _ = _sharded(spark, [("9-0-0", i, [(0, 0), (i, 9)]) for i in range(5)])
    tagged = {"tags": F.map_concat("tags", F.create_map(F.lit("a"), F.lit("b")))}
    both = C.changes_of(f, ("ADD", "one", {}), ("ADD", "two", tagged), ("REMOVE", "three", {}))
    want = C.change(f, "ADD", "one").unionByName(C.change(f, "ADD", "two", **tagged)).unionByName(C.change(f, "REMOVE", "three"))
    assert sorted(map(str, both.collect())) == sorted(map(str, want.collect())) and both.columns == want.columns
    assert both._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_changes_travel_by_their_shard(spark):
    _, ch = _sharded(spark, [("9-0-0", 1, [(0, 0), (1, 9)])])
    for df in (C.merge(ch), C.known_or_full(ch.withColumn("full", F.col("id") > 1), ch), C.with_shapes(ch.withColumn("geom", F.lit(None).cast(POINTS)), ch)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(country" in plan and "Join" not in plan
        assert all(line.split("hashpartitioning(")[1].count("#") == 2 for line in plan.splitlines() if "hashpartitioning(" in line)


def test_what_the_source_has_of_a_feature(spark):
    """Several changes of a feature get it; a feature of another shard, a missing one and null keys have none; complete changes need none."""
    f, ch = _sharded(spark, [("9-0-0", 1, [(0, 0), (1, 9)]), ("9-0-0", None, [(5, 5)]), ("9-0-1", 2, [(0, 0), (2, 9)])])
    _, more = _sharded(spark, [("9-0-1", 1, None), ("9-0-0", 3, None), ("9-0-0", 1, None), ("9-0-0", 1, None), ("9-0-0", None, None)])
    half = more.withColumn("full", F.lit(False))
    assert [(r.shard, r.id) for r in C.known_or_full(half, f).collect()] == [("9-0-0", 1), ("9-0-0", 1)]
    assert C.known_or_full(more, f).count() == 5
    shapes = sorted((str(r.id), r.shard, r["shape"] is not None) for r in C.with_shapes(half, f).collect())
    assert shapes == [("1", "9-0-0", True), ("1", "9-0-0", True), ("1", "9-0-1", False), ("3", "9-0-0", False), ("None", "9-0-0", False)]
    assert C.with_shapes(ch, f).where("shape = geom").count() == 3


def test_changes_to_be_merged_are_shuffled_once(spark):
    """Single changes pass beside merged ones; both are read from one shuffle, also where few columns are asked for."""
    _, ch = _sharded(spark, [("9-0-0", 1, [(0, 0), (1, 9)]), ("9-0-0", 2, [(0, 0), (2, 9)]), ("9-0-1", 3, None)])
    both = C.merge(ch.unionByName(ch.where("id = 1").withColumn("mutation", F.lit("n"))))
    assert sorted((r.shard, r.id, r.mutation, dict(r.tags), r.geom is None) for r in both.collect()) == [("9-0-0", 1, "m", {"k": "1"}, False), ("9-0-0", 2, "m", {"k": "2"}, False), ("9-0-1", 3, "m", {"k": "3"}, True)]
    few = both.select("id")
    few.collect()
    assert "ReusedExchange" in few._jdf.queryExecution().executedPlan().toString()
