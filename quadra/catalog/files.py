"""Queries that write files to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadra import tables as T
from quadra.catalog.edits import BOXES, ECH, SHARDED, _diff, boxes, edge_changes, sharded
from quadra.catalog.features import FEATURES, NAMED, features, flat
from quadra.functions import geometry as G
from quadra.functions.tiles import degrees_text, tile_name
from quadra.operators.snapshots import shard_statistics
from quadra.session import shared_path
from quadra.sources import readers, writers

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None, *ctes: str, keep: bool = True, once: tuple[str, ...] = ("sharded", "sharded_edges")):
    """``keep``: derived tables that the query reads more than once are stored first, those in ``once`` are not."""

    def add(f):
        QUERIES[name] = T.keeping(f, once) if keep else f
        if sql:
            SQL[name] = T.with_prelude(sql, *ctes)
        return f

    return add


def _text(df, s, name):
    path = shared_path(s, name)
    df.write.text(path)
    return path


@query("s1_lines", "SELECT zoom || '-' || x || '-' || y AS line FROM tree")
def s1(s, d):
    return readers.read_lines(s, _text(T.build_tree(T.nodes(s, d)).select(tile_name("zoom", "x", "y")), s, "lines"))


@query("s2_binary", "SELECT CAST(sum(length(zoom || '-' || x || '-' || y) + 1) AS BIGINT) AS bytes FROM tree")
def s2(s, d):
    path = _text(T.build_tree(T.nodes(s, d)).select(tile_name("zoom", "x", "y")), s, "binary")
    return readers.read_binary(s, path, "part-*").agg(F.sum(F.length("content")).cast("long").alias("bytes"))


@query("s3_sequence", "SELECT country AS key, CAST(n_nationkey AS BIGINT) AS value FROM boundaries b JOIN nation ON country = 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')")
def s3(s, d):
    path = shared_path(s, "sequence")
    pairs = T.boundaries(s, d).select("country", F.expr("cast(substring(country, 2) as bigint)"))
    pairs.rdd.map(tuple).saveAsSequenceFile(path)
    return readers.read_sequence(s, path, "string", "int").withColumn("value", F.col("value").cast("long"))


def _shards(s, d, folders=False):
    path = shared_path(s, "shards")
    writers.write_shards(sharded(s, d), path, "ZZ_SLASH_XX_YY_PBF", folders)
    return path


@query("k1_s5_all_shards", "SELECT country, shard, item_type, id, split_part(shard, '-', 1) || '/' || split_part(shard, '-', 2) || '-' || split_part(shard, '-', 3) || '.pbf' AS shard_path FROM sharded", *SHARDED)
def k1(s, d):
    return readers.read_all_shards(s, _shards(s, d)).select("country", "shard", "item_type", "id", "shard_path")


@query("s4_read_shards", "SELECT country, shard, item_type, id FROM sharded WHERE shard LIKE '%3'", *SHARDED)
def s4(s, d):
    wanted = boxes(s, d).where("shard like '%3'").select("country", "shard")
    return readers.read_shards(s, _shards(s, d), wanted.unionByName(s.createDataFrame([("XXX", "9-9-9")], "country string, shard string"))).select("country", "shard", "item_type", "id")


@query("s7_boundaries", "SELECT country, 0 AS poly, 0 AS ring, 5 AS points, min_lon_e7 AS lon_e7, min_lat_e7 AS lat_e7 FROM boundaries")
def s7(s, d):
    line = F.concat("country", F.lit("||"), G.box_wkt(*[F.col(c) for c in G.BOX]), F.lit("#"))
    read = readers.read_boundaries(s, _text(T.boundaries(s, d).select(line), s, "boundaries"))
    return read.select("country", "poly", "ring", F.size("geom").alias("points"), F.get("geom", 0)["lon_e7"].alias("lon_e7"), F.get("geom", 0)["lat_e7"].alias("lat_e7"))


@query("s8_tree", "SELECT zoom, x, y, final FROM tree")
def s8(s, d):
    path = shared_path(s, "beside")
    writers.write_beside(T.build_tree(T.nodes(s, d)), T.boundaries(s, d), path)
    return readers.read_tree(s, f"{path}/tree.txt")


@query("k10_beside", "SELECT 'tile' AS what, count(*) AS n FROM tree UNION ALL SELECT 'boundary', count(*) FROM boundaries")
def k10(s, d):
    path = shared_path(s, "beside")
    writers.write_beside(T.build_tree(T.nodes(s, d)), T.boundaries(s, d), path)
    n = lambda what, name: s.read.parquet(f"{path}/{name}").agg(F.lit(what).alias("what"), F.count(F.lit(1)).alias("n"))
    return n("tile", "tree").unionByName(n("boundary", "boundaries"))


@query("s9_tile_bounds", "SELECT zoom || '-' || x || '-' || y || '.pbf' AS name, min_lon_e7, min_lat_e7, max_lon_e7, max_lat_e7 FROM tiles")
def s9(s, d):
    t = T.tiles(s, d)
    line = F.concat(degrees_text("min_lat_e7"), F.lit(","), degrees_text("min_lon_e7"), F.lit(":"), degrees_text("max_lat_e7"), F.lit(","), degrees_text("max_lon_e7"), F.lit("|"), tile_name("zoom", "x", "y"), F.lit(".pbf"))
    lines = t.select(line.alias("value")).unionByName(t.agg(F.count(F.lit(1)).cast("string").alias("value")))
    return readers.read_tile_bounds(s, _text(lines, s, "bounds"))


@query("s10_files", "SELECT DISTINCT country, shard FROM sharded", *SHARDED)
def s10(s, d):
    """Shards share files: those of the listed files are the names that their rows have."""
    path = _shards(s, d)
    files = readers.list_files(s, path, r"\.parquet$", 2).where("length > 0")
    # the last part of a path, since a listing and a scan may write its beginning in different ways
    last = lambda c: F.element_at(F.split(c, "/country="), -1)
    held = readers.read_all_shards(s, path).select(last(F.col("_metadata.file_path")).alias("file"), "country", "shard").distinct()
    return held.join(files.select(last(F.col("path")).alias("file")), "file", "left_semi").select("country", "shard").distinct()


@query("s11_feature_text", "SELECT 'LINES' AS section, way_id * 1000000 AS id, n AS points, 'waterway=river' AS tags FROM ways WHERE kind = 'LINE'")
def s11(s, d):
    f = features(s, d).where("item_type = 'LINE'")
    geo = F.array_join(F.transform("geom", lambda p: F.concat(degrees_text(p["lat_e7"]), F.lit(","), degrees_text(p["lon_e7"]))), ":")
    tags = F.array_join(F.transform(F.map_entries("tags"), lambda e: F.concat(e["key"], F.lit(" -> "), e["value"])), " || ")
    rows = f.select(F.concat_ws("\n", F.lit("# Lines"), F.concat_ws(" && ", F.col("id").cast("string"), geo, tags)))
    return flat(readers.read_feature_text(s, _text(rows, s, "features")).select("section", "id", F.size("geom").cast("long").alias("points"), "tags"))


@query("k3_ldgeojson", "SELECT country, shard, '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || " + T.sql_degrees("min_lon_e7") + " || ',' || " + T.sql_degrees("min_lat_e7") + " || ']},\"properties\":{\"itemType\":\"POINT\",\"identifier\":' || id || ',\"tags\":{\"amenity\":\"' || substr(tags, 9) || '\"}}}' AS json FROM sharded WHERE item_type = 'POINT'", *SHARDED)
def k3(s, d):
    path = shared_path(s, "ldgeojson")
    writers.write_ldgeojson(sharded(s, d).where("item_type = 'POINT'"), path)
    return readers.read_named(s.read.text(path)).select("country", "shard", F.col("value").alias("json"))


@query("k4_geojson", "SELECT country, shard, count(*) AS features FROM sharded WHERE item_type = 'AREA' GROUP BY ALL", *SHARDED)
def k4(s, d):
    path = shared_path(s, "geojson")
    writers.write_geojson(sharded(s, d).where("item_type = 'AREA'"), path)
    n = F.expr("json_array_length(get_json_object(value, '$.features'))")
    return readers.read_named(s.read.text(path)).select("country", "shard", n.cast("long").alias("features"))


@query("k5_change_log", "SELECT country || '-0-applied' AS log, shard, count(*) AS n FROM ech WHERE mutation IS NOT NULL GROUP BY ALL", *ECH)
def k5(s, d):
    path = shared_path(s, "log")
    ch = edge_changes(s, d)
    writers.write_change_log({"generated": ch, "applied": ch}, path, "APPLIED")
    return readers.read_named(s.read.text(path)).groupBy("log", "shard").agg(F.count(F.lit(1)).alias("n"))


@query("k6_statistics", "SELECT country, item_type, 'all' AS key, count(*) AS n FROM sharded GROUP BY ALL", *SHARDED)
def k6(s, d):
    path = shared_path(s, "statistics")
    writers.write_statistics(shard_statistics(sharded(s, d), []), path)
    return s.read.option("header", True).csv(f"{path}/countries").select("country", "item_type", "key", F.col("n").cast("long").alias("n"))


@query("k7_write_delta", "SELECT way_id FROM snapshot WHERE way_id NOT IN (SELECT way_id FROM previous)")
def k7(s, d):
    path = shared_path(s, "delta")
    writers.write_delta(_diff(s, d), path, "ADDED")
    return s.read.text(path).select(F.get_json_object("value", "$.way_id").cast("long").alias("way_id"))


@query("k8_split_write", "SELECT split_part(shard, '-', 1) AS part, count(*) AS n FROM sharded GROUP BY ALL", *SHARDED)
def k8(s, d):
    path = shared_path(s, "split")
    writers.split_write(sharded(s, d).select("shard", "id"), path, F.concat(F.lit("zoom"), F.split("shard", "-")[0]))
    return s.read.parquet(path).groupBy(F.expr("substring(part, 5)").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("k9_write_filtered", "SELECT 'forests' AS filter, id FROM features WHERE item_type = 'AREA' UNION ALL SELECT 'water', id FROM features WHERE item_type = 'LINE' UNION ALL SELECT 'all', id FROM features", FEATURES)
def k9(s, d):
    path = shared_path(s, "filtered")
    writers.write_filtered(features(s, d), path, NAMED)
    return s.read.parquet(path).select("filter", "id")


@query("x14_record_keys", "SELECT '{\"country\":\"' || country || '\",\"shard\":\"' || shard || '\",\"metadata\":\"v1\"}' AS key, country, shard FROM boxes", *BOXES)
def x14(s, d):
    k = boxes(s, d).select(writers.record_key(F.col("country"), F.col("shard"), F.lit("v1")).alias("key"))
    return k.select("key", writers.parse_record_key(F.col("key"), "country").alias("country"), writers.parse_record_key(F.col("key"), "shard").alias("shard"))


@query("e4_provider", "SELECT item_type, count(*) AS n FROM sharded WHERE country = 'N12' GROUP BY ALL", *SHARDED)
def e4(s, d):
    """A provider is a function (spark, path) -> features; this one reads a country's shards."""
    provider = lambda spark, path: readers.read_all_shards(spark, path, "N12")
    return provider(s, _shards(s, d)).groupBy("item_type").agg(F.count(F.lit(1)).alias("n"))
