"""Rings and multipolygons of relations: lines chained by shared ends, holes given to their outer rings.

Chaining is list ranking. A line can be walked both ways; at a point where lines of one role end, they are paired in the order of the
lines, and walking on from a line's end is walking its partner. These successors are cycles; each knows its smallest line after
log2 of its length rounds of pointer doubling, and each line its distance from it after as many more. A coastline of fifty thousand
lines takes 16 rounds of joins, and no task holds more of it than its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.functions.geometry import POINTS, area2, degrees_text, is_closed
from quadra.operators.cover import build_cover, locate_in
from quadra.session import cut

_OF = ["relation_id", "role"]
_WALK = [*_OF, "line", "back"]


def _successors(lines: DataFrame) -> DataFrame:
    """(relation_id, role, line, back, next_line, next_back): the walk that follows each walk; null where a line's end is left open."""
    ends = F.explode(F.array(F.struct(F.get("geom", 0).alias("v"), F.lit(0).alias("side")), F.struct(F.element_at("geom", -1).alias("v"), F.lit(1).alias("side"))))
    rows = lines.select(*_OF, "line", ends.alias("e")).select(*_OF, "line", "e.*")
    at = W.partitionBy(*_OF, "v").orderBy("line", "side")
    partner = lambda f: f(F.struct(F.col("line").alias("line"), F.col("side").alias("side"))).over(at)
    paired = rows.withColumn("other", F.when(F.row_number().over(at) % 2 == 1, partner(F.lead)).otherwise(partner(F.lag)))
    return paired.select(*_OF, "line", (1 - F.col("side")).alias("back"), F.col("other.line").alias("next_line"), F.col("other.side").alias("next_back"))


def _ahead(state: DataFrame, columns: list[str]) -> DataFrame:
    """The state of each walk's pointer, under names with ``far_``."""
    far = state.select(*_OF, F.col("line").alias("next_line"), F.col("back").alias("next_back"), *[F.col(c).alias("far_" + c) for c in columns])
    return state.join(far, [*_OF, "next_line", "next_back"], "left")


def chain(lines: DataFrame) -> DataFrame:
    """(relation_id, role, ring): the rings of each relation and role. A role with a line whose end is left open, or with a ring of fewer
    than three corners, has one row with a null ring. ``lines``: (relation_id, role, geom), different ones."""
    rows = lines.where(F.size("geom") > 1).withColumn("line", F.sha2(F.col("geom").cast("string"), 256))
    whole = rows.where(is_closed(F.col("geom"))).select(*_OF, F.col("geom").alias("ring"))
    open_lines = cut(rows.where(~is_closed(F.col("geom"))))
    if open_lines.isEmpty():
        found = whole
    else:
        found = whole.unionByName(_walked(open_lines))
    bad = found.where(F.col("ring").isNull() | (F.size("ring") < 4)).select(*_OF).distinct()
    return found.join(bad, _OF, "left_anti").unionByName(bad.withColumn("ring", F.lit(None).cast(POINTS)))


def _walked(lines: DataFrame) -> DataFrame:
    """Rings of lines that are not closed."""
    following = cut(_successors(lines))
    loose = following.where("next_line is null").select(*_OF).distinct()
    least = F.struct("line", "back")
    state = cut(following.join(loose, _OF, "left_anti").withColumn("low", least))
    while True:
        met = _ahead(state, ["next_line", "next_back", "low"])
        new = cut(met.select(*_WALK, F.col("far_next_line").alias("next_line"), F.col("far_next_back").alias("next_back"), F.least("low", "far_low").alias("low"), (F.col("far_low") < F.col("low")).alias("moved")))
        state = new.drop("moved")
        if new.where("moved").isEmpty():
            break
    # of a ring's two directions the one that walks its smallest line forward
    labels = state.where("low.back = 0").select(*_WALK, F.col("low.line").alias("head"))
    rest = following.join(labels, _WALK)
    last = (F.col("next_line") == F.col("head")) & (F.col("next_back") == 0)
    state = cut(rest.select(*_WALK, "head", F.when(~last, F.col("next_line")).alias("next_line"), F.when(~last, F.col("next_back")).alias("next_back"), F.lit(0).alias("left")))
    while not state.where("next_line is not null").isEmpty():
        met = _ahead(state, ["next_line", "next_back", "left"])
        onward = F.col("next_line").isNotNull()
        state = cut(met.select(
            *_WALK, "head", F.col("far_next_line").alias("next_line"), F.col("far_next_back").alias("next_back"),
            (F.col("left") + F.when(onward, F.col("far_left") + 1).otherwise(0)).alias("left"),
        ))
    shapes = state.join(lines.select(*_OF, "line", "geom"), [*_OF, "line"])
    own = F.when(F.col("back") == 1, F.reverse("geom")).otherwise(F.col("geom"))
    parts = shapes.groupBy(*_OF, "head").agg(F.array_sort(F.collect_list(F.struct((-F.col("left")).alias("at"), own.alias("g")))).alias("p"))
    points = F.flatten(F.transform("p", lambda x: F.slice(x["g"], 1, F.size(x["g"]) - 1)))
    rings = parts.select(*_OF, F.concat(points, F.slice(points, 1, 1)).alias("ring"))
    return rings.unionByName(loose.withColumn("ring", F.lit(None).cast(POINTS)))


def multipolygons(rings: DataFrame) -> DataFrame:
    """(relation_id, parts): ``parts`` is an array of struct(outer, holes). A hole belongs to the smallest outer ring of its relation that
    holds more than half of its corners (rings may touch), and goes where none does. Islands in holes are parts of their own.
    Relations without a closed outer ring, or with an open one, have no row. ``rings``: the result of :func:`chain`."""
    rows = cut(rings.withColumn("ring_id", F.sha2(F.col("ring").cast("string"), 256)).withColumn("area", area2(F.col("ring"))))
    bad = rows.where("role = 'outer' and ring is null").select("relation_id")
    outer = rows.where("role = 'outer' and ring is not null").join(bad, "relation_id", "left_anti").dropDuplicates(["relation_id", "ring_id"])
    inner = rows.where("role = 'inner' and ring is not null").join(outer.select("relation_id").distinct(), "relation_id", "left_semi").dropDuplicates(["relation_id", "ring_id"])
    none = F.array().cast(f"array<{POINTS}>")
    shells = outer.select("relation_id", F.struct("relation_id", "ring_id").alias("shell"), F.col("ring").alias("outer"), none.alias("holes"), "area")
    corners = inner.select("relation_id", F.col("ring_id").alias("hole"), F.size("ring").alias("n"), F.explode(F.slice("ring", 1, F.greatest(F.size("ring") - 1, F.lit(1)))).alias("p"))
    corners = corners.select("relation_id", "hole", (F.col("n") - 1).alias("n"), "p.*")
    held = locate_in(corners, build_cover(shells.join(inner.select("relation_id").distinct(), "relation_id", "left_semi"), "shell"), key="shell", on=F.col("relation_id") == F.col("shell.relation_id"))
    most = held.groupBy("relation_id", "hole", "n", "shell").agg(F.count(F.lit(1)).alias("inside")).where(2 * F.col("inside") > F.col("n"))
    chosen = most.join(shells.select("shell", "area"), "shell").groupBy("relation_id", "hole").agg(F.min(F.struct("area", "shell"))["shell"].alias("shell"))
    holes = chosen.join(inner.select("relation_id", F.col("ring_id").alias("hole"), "ring"), ["relation_id", "hole"]).groupBy("shell").agg(F.array_sort(F.collect_list("ring")).alias("own"))
    parts = shells.select("relation_id", "shell", "outer").join(holes, "shell", "left").select("relation_id", F.struct("outer", F.coalesce("own", none).alias("holes")).alias("part"))
    return parts.groupBy("relation_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))


def nested(rings: DataFrame) -> DataFrame:
    """(relation_id, ring_id, depth): by how many other rings of its relation more than half of a ring's corners are held; rings that none
    holds have no row. ``rings``: (relation_id, ring_id, outer, holes), with empty holes."""
    several = rings.join(rings.groupBy("relation_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "relation_id", "left_semi")
    shells = several.withColumn("shell", F.struct("relation_id", "ring_id"))
    corners = several.select("relation_id", "ring_id", F.size("outer").alias("n"), F.explode(F.slice("outer", 1, F.greatest(F.size("outer") - 1, F.lit(1)))).alias("p"))
    corners = corners.select("relation_id", "ring_id", (F.col("n") - 1).alias("n"), "p.*")
    other = (F.col("relation_id") == F.col("shell.relation_id")) & (F.col("ring_id") != F.col("shell.ring_id"))
    held = locate_in(corners, build_cover(shells.select("shell", "outer", "holes"), "shell"), key="shell", on=other)
    most = held.groupBy("relation_id", "ring_id", "n", "shell").agg(F.count(F.lit(1)).alias("inside")).where(2 * F.col("inside") > F.col("n"))
    return most.groupBy("relation_id", "ring_id").agg(F.count(F.lit(1)).alias("depth"))


def parts_area2(parts: Column) -> Column:
    """Twice the area of a multipolygon, in square e7 units: its outer rings without their holes."""
    total = lambda of: F.aggregate(of, F.lit(0).cast("decimal(38,0)"), lambda a, r: (a + area2(r)).cast("decimal(38,0)"))
    return total(F.transform(parts, lambda p: p["outer"])) - total(F.flatten(F.transform(parts, lambda p: p["holes"])))


def parts_wkt(parts: Column) -> Column:
    """MULTIPOLYGON text of the parts."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat(degrees_text(p["lon_e7"]), F.lit(" "), degrees_text(p["lat_e7"]))), ", "), F.lit(")"))
    part = lambda p: F.concat(F.lit("("), F.array_join(F.transform(F.concat(F.array(p["outer"]), p["holes"]), ring), ", "), F.lit(")"))
    return F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(parts, part), ", "), F.lit(")"))
