import pytest
from pyspark.sql import functions as F

from quadra.functions import geometry as G
from quadra.functions import tags as P
from quadra.functions import tiles as X


def one(spark, column, schema="a int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


def test_path_schemes(spark):
    t = [F.lit(12)] * 3
    got = {s: one(spark, X.shard_path(*t, s)) for s in X.SCHEMES}
    assert got["ZZ_SUBFOLDER"] == "12/" and got["EMPTY"] == "" and got["ZZ_XX_YY_PBF"] == "12-12-12.pbf"
    assert got["ZZ_XX_YY_SUBFOLDERS_PBF"] == "12/12/12/12-12-12.pbf" and got["ZZ_SLASH_XX_YY_OSMPBF"] == "12/12-12.osm.pbf"
    with pytest.raises(ValueError):
        X.shard_path(*t, "zz/xx/")


def test_zoom_limit_and_unknown_item_type(spark):
    with pytest.raises(Exception, match="zoom is too high"):
        one(spark, X.tile_of(F.lit(0), F.lit(0), F.lit(19)))
    with pytest.raises(Exception, match="not an item type"):
        one(spark, P.item_type_name(F.lit(6)))


def test_names(spark):
    for name, want in (("9-261-195", (9, 261, 195)), ("XYZ_9-261-195", (9, 261, 195)), ("9-261", None), ("x", None)):
        got = one(spark, X.parse_tile(F.lit(name)))
        assert (tuple(got) if got else None) == want


def ring(*pts):
    return F.array(*[F.struct(F.lit(x).cast("long").alias("lon_e7"), F.lit(y).cast("long").alias("lat_e7")) for x, y in pts])


def lits(*box):
    return {c: F.lit(v).cast("long") for c, v in zip(G.BOX, box, strict=True)}


def square():
    return ring((0, 0), (0, 10), (10, 10), (10, 0), (0, 0))


def box(*v):
    return {c: F.lit(x).cast("long") for c, x in zip(G.BOX, v)}


def test_geometry(spark):
    assert one(spark, G.area2(square())) == 200
    assert one(spark, G.point_in_ring(F.lit(5), F.lit(5), square())) and not one(spark, G.point_in_ring(F.lit(15), F.lit(5), square()))
    diagonal = ring((0, 0), (10, 10))
    assert one(spark, G.polyline_meets_box(diagonal, box(4, 4, 6, 6)))
    assert not one(spark, G.polyline_meets_box(diagonal, box(6, 1, 9, 3)))
    assert one(spark, G.polyline_meets_box(diagonal, box(10, 10, 12, 12)))
    assert one(spark, G.polygon_meets_box(square(), box(2, 2, 3, 3))) and not one(spark, G.polygon_meets_box(square(), box(12, 2, 13, 3)))
    assert one(spark, G.holes_cover(F.array(square()), box(2, 2, 3, 3))) and not one(spark, G.holes_cover(F.array(square()), box(2, 2, 13, 3)))
    assert one(spark, X.degrees_text(F.lit(-5))) == "-0.0000005"


def test_clip(spark):
    cut = one(spark, G.clip_ring(square(), lits(5, -5, 20, 20)))
    assert {(p.lon_e7, p.lat_e7) for p in cut} == {(5, 0), (5, 10), (10, 10), (10, 0)} and cut[0] == cut[-1]
    assert one(spark, G.clip_ring(square(), lits(50, 50, 60, 60))) == []


def test_tag_filters(spark):
    df = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"a": "2"}), (3, None)], "id int, tags map<string,string>")
    ids = lambda rule: [r.id for r in df.where(P.tag_filter(rule)).orderBy("id").collect()]
    assert ids("a->*") == [1, 2] and ids("a->1&b->2") == [1] and ids("a->2|b->*") == [1, 2] and ids("a->!") == [3]
    assert df.where(P.NamedFilter("none").column()).count() == 3
