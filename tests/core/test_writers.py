"""The folders of written shards."""

import os

from pyspark.sql import functions as F

from quadra.sources import readers, writers


def _folders(path):
    return sum(name.startswith(("block=", "shard=")) for _, names, _ in os.walk(path) for name in names)


def _rows(spark):
    return spark.createDataFrame([("N01", f"9-{x}-{y}", x * 16 + y) for x in range(16) for y in range(16)] + [("N01", "3-1-2", 900), ("N02", "5-31-0", 901), ("N02", "14-16383-1", 902)], "country string, shard string, id long")


def test_block_of_a_shard(spark):
    df = spark.createDataFrame([("9-17-300",), ("3-1-2",), ("5-31-0",), ("14-16383-1",), ("6-1-1",)], "shard string")
    assert [r[0] for r in df.select(writers.block(F.col("shard"))).collect()] == ["5-1-18", "3-1-2", "5-31-0", "5-31-0", "5-0-0"]


def test_folders_do_not_grow_with_the_shards(spark, tmp_path):
    """256 shards of one block, and three others in three blocks of two countries."""
    path = str(tmp_path / "shards")
    writers.write_shards(_rows(spark), path)
    assert _folders(path) == 3
    got = readers.read_all_shards(spark, path)
    assert got.columns.count("block") == 0
    assert sorted(map(tuple, got.select("country", "shard", "id").collect())) == sorted(map(tuple, _rows(spark).collect()))


def test_listed_shards_are_read_from_both_layouts(spark, tmp_path):
    wanted = spark.createDataFrame([("N01", "9-2-3"), ("N02", "14-16383-1"), ("N09", "9-2-3")], "country string, shard string")
    for folders in (False, True):
        path = str(tmp_path / str(folders))
        writers.write_shards(_rows(spark), path, folders=folders)
        assert sorted(r.id for r in readers.read_shards(spark, path, wanted).collect()) == [35, 902]


def test_statistics_have_a_folder_for_each_country(spark, tmp_path):
    stats = _rows(spark).select("country", "shard", F.lit("AREA").alias("item_type"), F.lit("all").alias("key"), F.lit(2).cast("long").alias("n"))
    writers.write_statistics(stats, str(tmp_path))
    assert sorted(os.listdir(tmp_path / "shards"))[-2:] == ["country=N01", "country=N02"] and _folders(tmp_path) == 0
    back = spark.read.option("header", True).csv(str(tmp_path / "shards"))
    assert back.count() == 259 and back.where("shard = '9-2-3'").count() == 1
