"""File sources. Text formats are parsed by column expressions; nothing is opened outside of Spark's readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.functions.geometry import POINTS

_E7 = 10_000_000


def _e7(text: Column) -> Column:
    """Decimal degrees as text to an e7 integer, exactly."""
    return F.round(text.cast("decimal(18,10)") * _E7).cast("long")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of all files below a folder (S1); hidden names are skipped and .gz is decoded by Spark."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, content), one row a file."""
    r = spark.read.format("binaryFile")
    return (r.option("pathGlobFilter", glob) if glob else r).load(path).select("path", "content")


def read_sequence(spark: SparkSession, path: str, key: str = "string", value: str = "string") -> DataFrame:
    """(key, value) of sequence files (S3). The pairs must have the asked types; others are an error."""
    kinds = {"string": ("org.apache.hadoop.io.Text", str), "bigint": ("org.apache.hadoop.io.LongWritable", int), "int": ("org.apache.hadoop.io.IntWritable", int), "double": ("org.apache.hadoop.io.DoubleWritable", float)}
    (k_class, k_type), (v_class, v_type) = kinds[key], kinds[value]

    def checked(kv):
        if not (isinstance(kv[0], k_type) and isinstance(kv[1], v_type)):
            raise TypeError(f"expected ({key}, {value}), found ({type(kv[0]).__name__}, {type(kv[1]).__name__})")
        return kv

    rdd = spark.sparkContext.sequenceFile(path, k_class, v_class).map(checked)
    return spark.createDataFrame(rdd, f"key {key}, value {value}")


def read_all_shards(spark: SparkSession, path: str, country: str | None = None) -> DataFrame:
    """Every shard below a folder (S5), or those of one country: partition pruning, no listing by hand. The folders of
    :func:`quadra.sources.writers.write_shards`, which group shards, are no column here."""
    df = spark.read.parquet(path).drop("block")
    return df if country is None else df.where(F.col("country") == country)


def read_shards(spark: SparkSession, path: str, shards: DataFrame) -> DataFrame:
    """The listed (country, shard) of a folder (S4); a missing shard gives no rows. The folder's partitions are country and shard, or
    country and block of shards, so that Spark prunes them by the list at run time."""
    from quadra.sources.writers import block

    df, wanted = spark.read.parquet(path), shards.select("country", "shard").distinct()
    if "block" not in df.columns:
        return df.join(wanted, ["country", "shard"], "left_semi")
    return df.join(wanted.withColumn("block", block(F.col("shard"))), ["country", "block", "shard"], "left_semi").drop("block")


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """(country, poly, ring, geom) of ``CODE||POLYGON ((lon lat, ...), ...)#`` or MULTIPOLYGON lines (S7). Ring 0 is the
    outline, others are holes. Several shapes in a line are separated by #."""
    lines = spark.read.text(path).where(F.col("value").contains("||"))
    shapes = lines.select(F.split("value", r"\|\|")[0].alias("country"), F.posexplode(F.filter(F.split(F.split("value", r"\|\|")[1], "#"), lambda s: F.trim(s) != "")).alias("shape", "wkt"))
    polys = shapes.select("country", "shape", F.posexplode(F.regexp_extract_all("wkt", F.lit(r"\(\([^()]*\)(?:\s*,\s*\([^()]*\))*\)"), F.lit(0))).alias("part", "body"))
    rings = polys.select("country", "shape", "part", F.posexplode(F.regexp_extract_all("body", F.lit(r"\(([^()]+)\)"), F.lit(1))).alias("ring", "points"))
    geom = F.transform(F.split("points", r"\s*,\s*"), lambda p: F.struct(_e7(F.split(F.trim(p), r"\s+")[0]).alias("lon_e7"), _e7(F.split(F.trim(p), r"\s+")[1]).alias("lat_e7")))
    return rings.select("country", (F.col("shape") * 1000 + F.col("part")).cast("int").alias("poly"), "ring", geom.cast(POINTS).alias("geom"))


def parse_tree(lines: DataFrame, column: str = "value") -> DataFrame:
    """(zoom, x, y, final) of tree lines ``zoom-x-y`` with a + on inner tiles (S8); other lines are dropped."""
    pattern = r"^(\d+)-(\d+)-(\d+)(\+?)$"
    part = lambda i: F.regexp_extract(F.trim(column), pattern, i)
    return lines.where(F.trim(column).rlike(pattern)).select(part(1).cast("int").alias("zoom"), part(2).cast("long").alias("x"), part(3).cast("long").alias("y"), (part(4) == "").alias("final"))


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return parse_tree(spark.read.text(path))


def read_tile_bounds(spark: SparkSession, path: str) -> DataFrame:
    """(name, box) of ``lat,lon:lat,lon|name`` lines (S9); the count in the first line is no such line."""
    n = r"(-?[0-9.]+)"
    pattern = rf"^{n},{n}:{n},{n}\|(.+)$"
    part = lambda i: F.regexp_extract("value", pattern, i)
    return spark.read.text(path).where(F.col("value").rlike(pattern)).select(
        part(5).alias("name"), _e7(part(2)).alias("min_lon_e7"), _e7(part(1)).alias("min_lat_e7"), _e7(part(4)).alias("max_lon_e7"), _e7(part(3)).alias("max_lat_e7")
    )


def list_files(spark: SparkSession, path: str, regex: str | None = None, depth: int | None = None) -> DataFrame:
    """(path, length) of the files below a folder (S10): listing only, no content is read. ``depth``: at most so many
    folders below it."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    if regex is not None:
        df = df.where(F.col("path").rlike(regex))
    if depth is not None:
        base = path.rstrip("/").split("/")[-1]
        below = F.element_at(F.split("path", f"/{base}/"), -1)
        df = df.where(F.size(F.split(below, "/")) - 1 <= depth)
    return df


def read_named(lines: DataFrame) -> DataFrame:
    """Lines of GeoJSON that name their shard (:func:`quadra.sources.writers.write_ldgeojson`): ``value`` without that name, as plain GeoJSON, and
    ``shard``."""
    name = F.regexp_extract("value", r'^\{"shard":"([^"]*)",', 1)
    plain = F.concat(F.lit("{"), F.substr("value", F.length(name) + len('{"shard":"",') + 1))
    return lines.withColumns({"shard": name, "value": plain})


def read_feature_text(spark: SparkSession, path: str) -> DataFrame:
    """(section, id, geom, tags) of a text snapshot (S11): ``# Section`` headers, then lines ``id && lat,lon:... && k -> v ||
    k -> v``. The header of a line is the last one before it in its file."""
    from pyspark.sql import Window as W

    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    header = F.when(F.col("value").startswith("# "), F.upper(F.expr("substring(value, 3)")))
    rows = rows.withColumn("section", F.last(header, ignorenulls=True).over(W.partitionBy("file").orderBy("at")))
    rows = rows.where(F.col("value").contains("&&")).withColumn("p", F.split("value", r"\s*&&\s*"))
    geom = F.transform(F.split(F.col("p")[1], ":"), lambda p: F.struct(_e7(F.split(p, ",")[1]).alias("lon_e7"), _e7(F.split(p, ",")[0]).alias("lat_e7")))
    entries = F.transform(F.filter(F.split(F.coalesce(F.get("p", 2), F.lit("")), r"\s*\|\|\s*"), lambda t: t.contains("->")), lambda t: F.struct(F.trim(F.split(t, "->")[0]).alias("key"), F.trim(F.split(t, "->")[1]).alias("value")))
    return rows.select("section", F.col("p")[0].cast("long").alias("id"), geom.cast(POINTS).alias("geom"), F.map_from_entries(entries).alias("tags"))
