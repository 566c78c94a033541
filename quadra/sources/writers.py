"""File sinks: partitioned folders of Parquet, GeoJSON and csv. One write each, no loop of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.functions.tiles import degrees_text, shard_path, tile_name


#: Shards below a tile of this zoom share a folder.
BLOCK_ZOOM = 5


def block(shard: Column) -> Column:
    """The name of the tile at BLOCK_ZOOM above a shard, or the shard's own if it lies higher."""
    part = F.split(shard, "-")
    down = part[0].cast("int") - BLOCK_ZOOM
    up = lambda i: F.call_function("shiftright", part[i].cast("long"), down).cast("string")
    return F.when(down <= 0, shard).otherwise(F.concat_ws("-", F.lit(str(BLOCK_ZOOM)), up(1), up(2)))


def write_shards(df: DataFrame, path: str, scheme: str | None = None, folders: bool = False) -> None:
    """All shards of a country (K1), ordered by shard, in a folder for each :func:`block` of them, so that the files do not become as many as
    the shards, and a shard is a range of rows in one folder. ``folders``: one folder for each country and shard instead. With a
    ``scheme`` there is a column ``shard_path`` besides (K2)."""
    if scheme is not None:
        part = F.split("shard", "-")
        df = df.withColumn("shard_path", shard_path(part[0], part[1], part[2], scheme))
    if folders:
        df.repartition("country", "shard").write.mode("overwrite").partitionBy("country", "shard").parquet(path)
    else:
        blocks = df.withColumn("block", block(F.col("shard"))).repartition("country", "block").sortWithinPartitions("country", "block", "shard")
        blocks.write.mode("overwrite").partitionBy("country", "block").parquet(path)


def coordinates(geom: Column) -> Column:
    return F.array_join(F.transform(geom, lambda p: F.concat(F.lit("["), degrees_text(p["lon_e7"]), F.lit(","), degrees_text(p["lat_e7"]), F.lit("]"))), ",")


def feature_json(df: DataFrame) -> DataFrame:
    """Adds ``json``: the feature as GeoJSON text, geometry by item type."""
    c = coordinates(F.col("geom"))
    shape = (
        F.when(F.col("item_type").isin("POINT", "NODE"), F.concat(F.lit('{"type":"Point","coordinates":'), c, F.lit("}")))
        .when(F.col("item_type") == "AREA", F.concat(F.lit('{"type":"Polygon","coordinates":[['), c, F.lit("]]}")))
        .otherwise(F.concat(F.lit('{"type":"LineString","coordinates":['), c, F.lit("]}")))
    )
    props = F.to_json(F.struct(F.col("item_type").alias("itemType"), F.col("id").alias("identifier"), "tags"))
    return df.withColumn("json", F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(shape, F.lit("null")), F.lit(',"properties":'), props, F.lit("}")))


def _named(json: Column) -> Column:
    """GeoJSON with the shard as its first member, which GeoJSON allows and readers pass over."""
    return F.concat(F.lit('{"shard":"'), F.col("shard"), F.lit('",'), F.substr(json, F.lit(2)))


def write_ldgeojson(df: DataFrame, path: str, folders: bool = False) -> None:
    """One GeoJSON feature a line, gzip, by country and shard (K3), in a folder for each :func:`block` of shards; a line names its shard
    first, see :func:`readers.read_named`. ``folders``: one folder for each shard instead, as plain GeoJSON."""
    at = ["country", "shard" if folders else "block"]
    rows = feature_json(df).withColumn("block", block(F.col("shard"))).repartition(*at).sortWithinPartitions(*dict.fromkeys([*at, "shard"]))
    value = F.col("json") if folders else _named(F.col("json"))
    rows.select(*at, value.alias("value")).write.mode("overwrite").partitionBy(*at).option("compression", "gzip").text(path)


def write_geojson(df: DataFrame, path: str, folders: bool = False) -> None:
    """One FeatureCollection for each shard (K4), a line in the file of its :func:`block`, which names its shard first. A shard is a tile
    with a bounded number of features, see the tree's limit. Features travel once, by block. ``folders``: one folder for each shard
    instead, as plain GeoJSON."""
    body = feature_json(df).select("country", "shard", block(F.col("shard")).alias("block"), "json")
    body = body.repartition("country", "shard" if folders else "block").groupBy("country", "block", "shard").agg(F.array_sort(F.collect_list("json")).alias("all"))
    value = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("all", ","), F.lit("]}"))
    at = ["country", "shard" if folders else "block"]
    body = body.select(*at, (value if folders else _named(value)).alias("value"))
    body.sortWithinPartitions(*at).write.mode("overwrite").partitionBy(*at).text(path)


LOG_STAGES = {"ALL": ["generated", "assigned", "applied"], "APPLIED": ["applied"], "NONE": []}


def write_change_log(stages: dict[str, DataFrame], path: str, level: str = "ALL", folders: bool = False) -> None:
    """Changes of the stages generated, assigned and applied as GeoJSON lines by log and shard (K5), in a folder for each :func:`block` of
    shards; a line names its shard first, see :func:`readers.read_named`. ``folders``: one folder for each shard instead, as plain GeoJSON.
    ``level``: ALL, APPLIED or NONE. Only changes that name their mutation are logged. What travels are the changes, their text is made where
    they are written."""
    out = None
    for stage in LOG_STAGES[level]:
        if stage in stages:
            rows = stages[stage].where("mutation is not null").withColumn("log", F.concat_ws("-", "country", F.col("level").cast("string"), F.lit(stage)))
            rows = rows.select("log", "shard", "item_type", "id", "geom", "tags", "change_type", "mutation", "source_shard")
            out = rows if out is None else out.unionByName(rows)
    if out is not None:
        at = ["log", "shard" if folders else "block"]
        out = out.withColumn("block", block(F.col("shard"))).repartition("log", "shard" if folders else "block").sortWithinPartitions(*dict.fromkeys([*at, "shard"]))
        extra = F.to_json(F.struct(F.col("change_type").alias("featureChangeType"), F.concat_ws(":", "mutation", "source_shard").alias("mutator")))
        line = F.concat(F.expr("substring(json, 1, length(json) - 1)"), F.lit(',"change":'), extra, F.lit("}"))
        rows = feature_json(out).select(*at, (line if folders else _named(line)).alias("value"))
        rows.write.mode("overwrite").partitionBy(*at).option("compression", "gzip").text(path)


def write_statistics(stats: DataFrame, path: str) -> None:
    """csv with header, gzip: a row for each country, shard and key, in a folder for each country, and summed by country (K6)."""
    from quadra.operators.snapshots import country_statistics

    put = lambda df, to: df.write.mode("overwrite").partitionBy("country").option("header", True).option("compression", "gzip").csv(to)
    put(stats.repartition("country", block(F.col("shard"))).sortWithinPartitions("country", "shard"), f"{path}/shards")
    put(country_statistics(stats).repartition("country"), f"{path}/countries")


def write_delta(diff: DataFrame, path: str, kind: str | None = None) -> None:
    """All differences, or those of one kind (ADDED, CHANGED, REMOVED), as JSON lines (K7)."""
    rows = diff if kind is None else diff.where(F.col("kind") == kind)
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def split_write(df: DataFrame, path: str, key: Column) -> None:
    """One output for each value of a reduced key (K8), in one write. Rows stay in the task that has them, as a value may hold most of
    them: an output has at most a file for each task."""
    df.withColumn("part", key).write.mode("overwrite").partitionBy("part").parquet(path)


def write_filtered(df: DataFrame, path: str, filters: list) -> None:
    """One output for each named filter (K9), in one pass. Rows stay in the task that has them, see :func:`split_write`."""
    from quadra.plans.build import filtered_outputs

    filtered_outputs(df, filters).write.mode("overwrite").partitionBy("filter").parquet(path)


def write_beside(tiles: DataFrame, boundaries: DataFrame, path: str) -> None:
    """The tree (as text lines and as table) and the boundaries next to the data."""
    line = F.concat(tile_name("zoom", "x", "y"), F.when(F.col("final"), "").otherwise("+"))
    tiles.select(line.alias("value")).write.mode("overwrite").text(f"{path}/tree.txt")
    tiles.write.mode("overwrite").parquet(f"{path}/tree")
    boundaries.write.mode("overwrite").parquet(f"{path}/boundaries")


def record_key(country: Column, shard: Column, metadata: Column) -> Column:
    """JSON key of a country shard."""
    return F.to_json(F.struct(country.alias("country"), shard.alias("shard"), metadata.alias("metadata")))


def parse_record_key(key: Column, field: str) -> Column:
    """A field of a record key; a missing field is an error."""
    found = F.get_json_object(key, f"$.{field}")
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit(f"no {field} in "), key)))
