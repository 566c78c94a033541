"""Differences between snapshots, statistics, and checks of shards and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, kind, old_..., new_...): ADDED, CHANGED or REMOVED rows (J19); equal rows are left out, so that the diff of
    equal snapshots is an empty table. Nulls compare as values."""
    a = old.select(*keys, F.lit(True).alias("in_old"), *[F.col(v).alias("old_" + v) for v in values])
    b = new.select(*keys, F.lit(True).alias("in_new"), *[F.col(v).alias("new_" + v) for v in values])
    same = F.lit(True)
    for v in values:
        same = same & F.col("old_" + v).eqNullSafe(F.col("new_" + v))
    kind = F.when(F.col("in_old").isNull(), "ADDED").when(F.col("in_new").isNull(), "REMOVED").when(~same, "CHANGED")
    return a.join(b, keys, "full_outer").withColumn("kind", kind).where("kind is not null").drop("in_old", "in_new")


def diff_summary(d: DataFrame, by: list[str]) -> DataFrame:
    """Number of differences by kind and columns."""
    return d.groupBy("kind", *by).agg(F.count(F.lit(1)).alias("n"))


def shard_statistics(features: DataFrame, keys: list[str]) -> DataFrame:
    """(country, shard, item_type, key, n): features in total (key ``all``) and by tag key (A9); shards without features
    have no rows."""
    named = F.concat(F.array(F.lit("all")), F.filter(F.map_keys("tags"), lambda k: k.isin(keys)))
    return features.select("country", "shard", "item_type", F.explode(named).alias("key")).groupBy("country", "shard", "item_type", "key").agg(F.count(F.lit(1)).alias("n"))


def country_statistics(stats: DataFrame) -> DataFrame:
    """Sums of shard statistics by country (A10)."""
    return stats.groupBy("country", "item_type", "key").agg(F.sum("n").alias("n"))


def missing_shards(expected: DataFrame, existing: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Expected shards that are not there (J7, U4), for the wanted countries."""
    return countries(expected, include, exclude).distinct().join(existing.distinct(), ["country", "shard"], "left_anti")


def countries(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Rows of the included countries without the excluded ones; a country in both lists is an error."""
    both = set(include or []) & set(exclude or [])
    if both:
        raise ValueError(f"countries both included and excluded: {sorted(both)}")
    if include:
        df = df.where(F.col("country").isin(list(include)))
    return df.where(~F.col("country").isin(list(exclude))) if exclude else df


def missing_files(expected: DataFrame, files: DataFrame) -> DataFrame:
    """(name, problem): expected names that are not listed, and files without content (J8); names are always compared."""
    lost = expected.select("name").distinct().join(files.select("name"), "name", "left_anti").withColumn("problem", F.lit("missing"))
    return lost.unionByName(files.where("length = 0").select("name", F.lit("empty").alias("problem")))


def log_manifest(levels: DataFrame, shards: DataFrame) -> DataFrame:
    """(country, path) of all log files that may be written (K11): levels (level) by shards (country, shard). The levels are
    a handful of rows that the caller numbers."""
    name = F.concat_ws("-", "country", F.col("level").cast("string"), F.lit("applied"))
    every = shards.withColumn("level", F.explode(F.lit(sorted(r[0] for r in levels.collect()))))
    return every.select("country", F.concat(F.lit("logs/"), name, F.lit("/"), name, F.lit("_"), F.col("shard"), F.lit(".geojson.gz")).alias("path"))
