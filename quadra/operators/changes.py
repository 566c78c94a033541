"""Feature changes: making, assigning, merging, filtering and applying them.

A change is a row (CHANGE): target country and shard, item_type, id, change_type (ADD or REMOVE), the new view
(geom, tags, start_node, end_node; null where a field stays as it is), ``full`` (the view is complete), the box of what
changes, the mutation that made it, the shard it was made in, and the level. Sharded features (SHARDED) have the same
view columns. All steps keep changes as rows; nothing lists a shard's changes in one place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.functions.geometry import BOX, POINTS, box_columns, boxes_meet, polyline_meets_box
from quadra.functions.tags import put_tag
from quadra.functions.tiles import tile_bounds
from quadra.operators.spatial import join_cells

KEY = ["country", "shard", "item_type", "id"]
VIEW = {"geom": POINTS, "tags": "map<string,string>", "start_node": "bigint", "end_node": "bigint"}
SHARDED = [*KEY, *VIEW, *BOX]
CHANGE = [*KEY, "change_type", "full", *VIEW, *BOX, "mutation", "source_shard", "level"]
#: The box of a row's shard, which rows may have besides.
SHARD_BOX = ["s_" + c for c in BOX]
#: What equal changes have in common, besides their tags.
SAME = ["change_type", "full", "geom", "start_node", "end_node", *BOX]
PREFIX = "mutator:"


def _columns(change_type: str, mutation: str, level: int = 0, **view: Column) -> list[Column]:
    def value(name: str, kind: str) -> Column:
        if change_type == "REMOVE":
            return F.lit(None).cast(kind)
        return view[name] if name in view else F.col(name) if not view else F.lit(None).cast(kind)

    return [
        *[F.col(c) for c in KEY], F.lit(change_type).alias("change_type"), F.lit(change_type == "REMOVE" or not view).alias("full"), *[value(n, k).alias(n) for n, k in VIEW.items()],
        *[F.col(c) for c in BOX], F.lit(mutation).alias("mutation"), F.col("shard").alias("source_shard"), F.lit(level).alias("level"),
    ]


def change(features: DataFrame, change_type: str, mutation: str, level: int = 0, **view: Column) -> DataFrame:
    """Changes of sharded features. ADD without ``view`` repeats the whole feature (full); with it, only the given fields
    are set. REMOVE has no view. Features that have their shard's box (SHARD_BOX) pass it on."""
    return features.select(*_columns(change_type, mutation, level, **view), *[c for c in SHARD_BOX if c in features.columns])


def changes_of(features: DataFrame, *made: tuple[str, str, dict[str, Column]]) -> DataFrame:
    """Several changes of each feature, (change_type, mutation, view) as for :func:`change`, made where it is: features are derived, dealt
    and read once for all of them."""
    return features.select(F.inline(F.array(*[F.struct(*_columns(kind, mutation, **view)) for kind, mutation, view in made])))


def _beside(rows: DataFrame, others: DataFrame, **values: Column) -> DataFrame:
    """Adds to each row what ``others`` have of its feature, null where they have none. Both travel by their shard: rows that lie next to
    each other stay so, and take a fraction of the bytes that they do when dealt by the whole key, as a join would."""
    found = others.dropna(subset=KEY).select(*KEY, F.struct(*[v.alias(n) for n, v in values.items()]).alias("__found"), F.lit(False).alias("__row"))
    both = rows.withColumn("__row", F.lit(True)).unionByName(found, allowMissingColumns=True).repartition("country", "shard")
    both = both.withColumn("__found", F.first("__found", ignorenulls=True).over(W.partitionBy("id", "item_type", "shard", "country"))).where("__row")
    return both.select(*rows.columns, *[F.col("__found")[n].alias(n) for n in values])


# ---------------------------------------------------------------- assignment


def inside_source(changes: DataFrame, shards: DataFrame | None) -> DataFrame:
    """Changes whose box meets the shard that made them (P13). ``shards``: (country, shard, box), or None if shards are tiles, whose name
    ``zoom-x-y`` gives the box."""
    if shards is None:
        return with_named_box(changes, "source_shard").where(boxes_meet(box_columns(), box_columns("s_"))).select(*CHANGE)
    s = shards.select("country", F.col("shard").alias("source_shard"), *[F.col(c).alias("s_" + c) for c in BOX])
    return changes.join(s, ["country", "source_shard"]).where(boxes_meet(box_columns(), box_columns("s_"))).select(*CHANGE)


def assign(changes: DataFrame, shards: DataFrame) -> DataFrame:
    """Each change once for each shard of its country that its box meets (J10); changes that several shards made alike
    stay apart by their source."""
    pairs = join_cells(changes, shards.select("country", "shard", *BOX), [("country", "country")])
    return pairs.select(*[F.col("b_shard").alias("shard") if c == "shard" else F.col("a_" + c).alias(c) for c in CHANGE])


def assign_once(changes: DataFrame, shards: DataFrame) -> DataFrame:
    """What :func:`assign` gives, with equal changes of one mutation as one for each shard: they are brought together before they are
    dealt out, so that a change that m shards made goes to its m shards in m rows, not in m * m. Their source is the target shard if
    it is among the shards that made them, else the first of these."""
    made = changes.withColumn("__tags", F.array_sort(F.map_entries("tags"))).groupBy("country", "item_type", "id", "mutation", *SAME, "__tags")
    made = made.agg(F.collect_set("source_shard").alias("__sources"), F.min("level").alias("level"))
    pairs = join_cells(made, shards.select("country", "shard", *BOX), [("country", "country")])
    source = F.when(F.array_contains("a___sources", F.col("b_shard")), F.col("b_shard")).otherwise(F.array_min("a___sources"))
    given = {"shard": F.col("b_shard"), "source_shard": source, "tags": F.map_from_entries("a___tags")}
    return pairs.select(*[(given[c] if c in given else F.col("a_" + c)).alias(c) for c in CHANGE])


# ---------------------------------------------------------------- merging


@dataclass(frozen=True)
class MergePolicy:
    """What resolves a conflict: by the exact sequence of failures, by a part of it, or by a single failure."""

    exact: dict = field(default_factory=dict)
    part: dict = field(default_factory=dict)
    root: dict = field(default_factory=dict)

    def strategy(self, failures: tuple[str, ...]) -> Callable[[dict, dict], dict]:
        if failures in self.exact:
            return self.exact[failures]
        for wanted, strategy in self.part.items():
            if any(failures[i : i + len(wanted)] == wanted for i in range(len(failures))):
                return strategy
        for name, strategy in self.root.items():
            if name in failures:
                return strategy
        raise ValueError(f"changes cannot be merged: {', '.join(failures)}")


def always_left(left: dict, right: dict) -> dict:
    """F1."""
    return left


def remove_over_add(left: dict, right: dict) -> dict:
    """the removal of the two; both must be about the same feature."""
    if (left["item_type"], left["id"]) != (right["item_type"], right["id"]):
        raise ValueError("changes of different features")
    for c in (left, right):
        if c["change_type"] == "REMOVE":
            return c
    raise ValueError("neither change is a removal")


def prioritize_tag(rules: list[tuple[str, str, bool]]) -> Callable[[dict, dict], dict]:
    """(key, value or *, exclusive) in order; the first rule that one side alone matches decides. If both match, an
    exclusive rule is passed over and another takes the left."""
    def matches(c: dict, key: str, value: str) -> bool:
        tags = c["tags"] or {}
        return key in tags and value in ("*", tags[key])

    def resolve(left: dict, right: dict) -> dict:
        for key, value, exclusive in rules:
            a, b = matches(left, key, value), matches(right, key, value)
            if a != b:
                return left if a else right
            if a and not exclusive:
                return left
        raise ValueError("no rule decides")

    return resolve


def lower_node_id(left: dict, right: dict) -> dict:
    """two additions of one edge; the full one is the base, differing ends take the smaller node."""
    if left["id"] != right["id"]:
        raise ValueError("changes of different features")
    if any(c["item_type"] != "EDGE" or c["change_type"] != "ADD" for c in (left, right)):
        raise ValueError("not two added edges")
    base = dict(left if left["full"] or not right["full"] else right)
    for end in ("start_node", "end_node"):
        ids = [c[end] for c in (left, right) if c[end] is not None]
        base[end] = min(ids) if ids else None
    return base


def merge_pair(left: dict, right: dict, policy: MergePolicy) -> dict:
    """Field by field: equal values or one side null fit; tags unite unless a key has two values; ADD does not fit REMOVE."""
    failures = []
    if left["change_type"] != right["change_type"]:
        failures.append("ADD_REMOVE")
    else:
        for name in ("geom", "start_node", "end_node"):
            if left[name] is not None and right[name] is not None and left[name] != right[name]:
                failures.append(name.upper())
        a, b = left["tags"] or {}, right["tags"] or {}
        if any(a[k] != b[k] for k in a.keys() & b.keys()):
            failures.append("TAGS")
    if failures:
        return policy.strategy(("MERGE", *failures))(left, right)
    out = {k: left[k] if left[k] is not None else right[k] for k in left}
    if left["tags"] is not None and right["tags"] is not None:
        out["tags"] = {**left["tags"], **right["tags"]}
    out["full"] = left["full"] or right["full"]
    for c in BOX:
        out[c] = (min if c.startswith("min") else max)(left[c], right[c])
    return out


def fold(changes: list[dict], policy: MergePolicy) -> dict:
    """Two at a time from the front, the result goes to the back."""
    queue = list(changes)
    while len(queue) > 1:
        a, b, *queue = queue
        queue.append(merge_pair(a, b, policy))
    return queue[0]


def _once(changes: DataFrame) -> DataFrame:
    """Equal changes of one mutation as one. They are equal in all of their view, by the view itself; tags as sorted text
    only tell the groups apart, which maps cannot."""
    source = F.coalesce(F.max(F.when(F.col("source_shard") == F.col("shard"), F.col("source_shard"))), F.min("source_shard")).alias("source_shard")
    entries = F.array_sort(F.map_entries("tags"))
    grouped = changes.withColumn("__tags", entries).groupBy(*KEY, "mutation", *SAME, "__tags").agg(source, F.min("level").alias("level"))
    return grouped.withColumn("tags", F.map_from_entries("__tags")).select(*CHANGE)


def merge(changes: DataFrame, policy: MergePolicy = MergePolicy(), more: list[str] = ()) -> DataFrame:
    """One change for each (country, shard, item_type, id) and ``more`` (A6; A7 with ``more = ["mutation"]``).

    A mutation makes the same change in every shard that holds a feature; equal changes of one mutation are one, and
    keep the target shard as their source if it is among them. Keys with a single change pass as they are, without
    leaving the JVM. Only the others are brought together, ordered by mutation and source shard (so that results
    repeat), and folded. Changes travel once, by their shard, where what is alike lies together and takes fewer bytes; all groups are made
    where they are then. The result is not stored."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    keys = [*KEY, *more]
    # as many tasks as the session says, since folding takes time and not bytes, by which Spark would put them together
    tasks = int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _once(changes.select(*CHANGE).repartition(tasks, "country", "shard"))
    made = F.struct("mutation", "source_shard", "change_type", "full", *VIEW_SORTABLE, F.map_entries("tags").alias("entries"), *BOX, "level")
    # grouped with all columns, so that both parts below read the same and Spark shuffles it once
    grouped = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(made)).alias("all"))
    many = grouped.where(F.size("all") > 1)
    schema = rows.select(*CHANGE).schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                items = [{**{k: r[k] for k in KEY}, **{k: v for k, v in c.items() if k != "entries"}, "tags": None if c["entries"] is None else {e["key"]: e["value"] for e in c["entries"]}} for c in r["all"]]
                done = fold(items, policy)
                out.append({c: (list(done["tags"].items()) if c == "tags" and done["tags"] is not None else done[c]) for c in CHANGE})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    single = grouped.where(F.size("all") == 1).select(*KEY, F.inline("all")).withColumn("tags", F.map_from_entries("entries"))
    return single.select(*CHANGE).unionByName(many.mapInArrow(run, schema))


VIEW_SORTABLE = ["geom", "start_node", "end_node"]


# ---------------------------------------------------------------- filters


def in_shard(rows: DataFrame, shards: DataFrame | None) -> DataFrame:
    """Adds the box of each row's shard (SHARD_BOX). ``shards``: (country, shard, box); rows of others go. Without them the rows do not
    travel for it: they have their shard's box from where they were dealt, or shards are tiles, whose name ``zoom-x-y`` gives the box."""
    if shards is not None:
        return rows.drop(*SHARD_BOX).join(shards.select("country", "shard", *[F.col(c).alias("s_" + c) for c in BOX]), ["country", "shard"])
    return rows if set(SHARD_BOX) <= set(rows.columns) else with_named_box(rows, "shard")


def with_named_box(rows: DataFrame, shard: str) -> DataFrame:
    """Adds the box (SHARD_BOX) of the tile that a column names ``zoom-x-y``."""
    part = F.split(shard, "-")
    named = tile_bounds(part[0].cast("int"), part[1].cast("long"), part[2].cast("long"))
    # as a generator, so that a box is computed once for a row and not wherever a test reads it
    return rows.drop(*SHARD_BOX).select("*", F.inline(F.array(F.struct(*[named[c].alias("s_" + c) for c in BOX]))))


def known_or_full(changes: DataFrame, source: DataFrame) -> DataFrame:
    """An incomplete change needs its feature in the shard. Complete ones do not travel for it."""
    full = F.coalesce("full", F.lit(False))
    known = _beside(changes.where(~full), source, known=F.lit(True)).where("known")
    return changes.where(full).unionByName(known.select(*changes.columns))


def with_shapes(changes: DataFrame, source: DataFrame) -> DataFrame:
    """Adds ``shape``: the change's geometry, else the source's; relations keep none. Only changes that need the source's travel."""
    needs = F.coalesce((F.col("item_type") != "RELATION") & F.col("geom").isNull(), F.lit(False))
    own = changes.where(~needs).withColumn("shape", F.when(F.col("item_type") != "RELATION", F.col("geom")))
    return own.unionByName(_beside(changes.where(needs), source.where("item_type <> 'RELATION'"), shape=F.col("geom")))


def overlapping_edges(changes: DataFrame, source: DataFrame, shards: DataFrame | None) -> DataFrame:
    """An ADD of an edge stays if its new or its source shape meets the shard; other changes pass. Shapes are tested where they
    are, so that only keys travel to the source's. ``shards``: see :func:`in_shard`."""
    box = box_columns("s_")
    meets = F.coalesce(polyline_meets_box(F.col("geom"), box), F.lit(False))
    tested = in_shard(changes, shards).withColumn("__meets", (F.col("item_type") != "EDGE") | (F.col("change_type") != "ADD") | meets)
    there = in_shard(source.where("item_type = 'EDGE'"), shards).where(meets).select(*KEY)
    # both sides are read twice, but what they are made of is shuffled once
    kept = _beside(tested.where("not __meets").select(*CHANGE), there, there=F.lit(True)).where("there")
    return tested.where("__meets").select(*CHANGE).unionByName(kept.select(*CHANGE))


def overlapping_relations(changes: DataFrame, leaves: DataFrame, shapes: DataFrame, shards: DataFrame) -> DataFrame:
    """An ADD of a relation stays if a member at any depth meets the shard. ``leaves``: (relation_id, member_type,
    member_id) at any depth; ``shapes``: (member_type, member_id, box)."""
    relation = (F.col("item_type") == "RELATION") & (F.col("change_type") == "ADD")
    hits = _met(leaves, shapes, shards)
    return changes.where(~relation).unionByName(changes.where(relation).join(hits, ["country", "shard", "id"], "left_semi").select(*changes.columns))


def _met(leaves: DataFrame, shapes: DataFrame, shards: DataFrame) -> DataFrame:
    """(country, shard, id) of the relations of which a member meets the shard: each member's box is dealt to the shards that it meets,
    so that no relation's shards are paired with all of its members. Members that share a box are one."""
    boxes = leaves.join(shapes, ["member_type", "member_id"]).select(F.col("relation_id").alias("id"), *BOX).distinct()
    pairs = join_cells(boxes, shards.select("country", "shard", *BOX))
    return pairs.select(F.col("b_country").alias("country"), F.col("b_shard").alias("shard"), F.col("a_id").alias("id")).distinct()


def own_removals(changes: DataFrame) -> DataFrame:
    """A removed edge stays only if it names no source, or this shard."""
    foreign = (F.col("item_type") == "EDGE") & (F.col("change_type") == "REMOVE") & F.col("source_shard").isNotNull() & (F.col("source_shard") != F.col("shard"))
    return changes.where(~foreign)


def own_nodes(changes: DataFrame, edges: DataFrame, shards: DataFrame | None) -> DataFrame:
    """An added node stays if it names no source, or this shard, or an edge at it meets the shard. ``edges``:
    (start_node, end_node, geom), reverses may be left out; ``shards``: see :func:`in_shard`. Nodes and ends meet by node, once."""
    foreign = (F.col("item_type") == "NODE") & (F.col("change_type") == "ADD") & F.col("source_shard").isNotNull() & (F.col("source_shard") != F.col("shard"))
    at = edges.select(F.explode(F.array("start_node", "end_node")).alias("id"), "geom")
    hit = in_shard(changes.where(foreign).select("country", "shard", "id").repartition("id").distinct(), shards).join(at, "id")
    hit = hit.where(polyline_meets_box(F.col("geom"), box_columns("s_"))).select("country", "shard", "id").distinct()
    return changes.where(~foreign).unionByName(changes.where(foreign).join(hit, ["country", "shard", "id"], "left_semi").select(*changes.columns))


def without_geometric(changes: DataFrame, geometric: DataFrame) -> DataFrame:
    """ADDs of edges that belong to a geometric relation (id) go."""
    edge = (F.col("item_type") == "EDGE") & (F.col("change_type") == "ADD")
    return changes.where(~edge).unionByName(changes.where(edge).join(geometric.select("id").distinct(), "id", "left_anti").select(*changes.columns))


def for_log(changes: DataFrame) -> DataFrame:
    """P20: only changes that name their mutation."""
    return changes.where("mutation is not null")


def metadata(changes: DataFrame) -> Column:
    """``name:shard``."""
    return F.concat_ws(":", "mutation", "source_shard")


def with_mutation_tags(changes: DataFrame, source: DataFrame) -> DataFrame:
    """ADDs get ``mutator:<name> = <level>`` and, where the feature is new, ``iso_country_code``. Tags come from the
    change, else from the source. Other changes pass as they are and do not travel to the source."""
    named = F.coalesce((F.col("change_type") == "ADD") & F.col("mutation").isNotNull(), F.lit(False))
    out = _beside(changes.where(named), source, source_tags=F.col("tags"), known=F.lit(True))
    base = F.coalesce("tags", "source_tags", F.create_map().cast("map<string,string>"))
    marked = F.map_concat(F.map_filter(base, lambda k, _: k != F.concat(F.lit(PREFIX), F.col("mutation"))), F.create_map(F.concat(F.lit(PREFIX), F.col("mutation")), F.col("level").cast("string")))
    marked = F.when(F.col("known").isNull(), put_tag(marked, "iso_country_code", F.col("country"))).otherwise(marked)
    return changes.where(~named).unionByName(out.withColumn("tags", marked).select(*changes.columns))


def strip_mutation_tags(df: DataFrame) -> DataFrame:
    """P24."""
    return df.withColumn("tags", F.map_filter("tags", lambda k, _: ~k.startswith(PREFIX)))


def lift_mutation_tags(df: DataFrame) -> DataFrame:
    """(country, shard, key, value): mutation tags as dataset metadata, key ``tag:TYPE:id`` (P25)."""
    return df.select("country", "shard", "item_type", "id", F.explode("tags").alias("k", "value")).where(F.col("k").startswith(PREFIX)).select("country", "shard", F.concat_ws(":", "k", "item_type", F.col("id").cast("string")).alias("key"), "value")


def generated_removes(changes: DataFrame, source: DataFrame, shards: DataFrame | None, keep: DataFrame | None = None, leaves: DataFrame | None = None, shapes: DataFrame | None = None, near: DataFrame | None = None) -> DataFrame:
    """REMOVEs for edges and relations of a shard that a kept ADD does not bring back and that lie outside of the shard: an
    edge whose line does not meet it, a relation without a member, at any depth, whose box does. ``keep`` (id) are left alone.
    ``leaves`` and ``shapes``: see :func:`overlapping_relations`. ``near`` (country, shard, id) names the relations that stay instead of
    them, such as those by shape. Without either a relation's own box counts. What lies outside is found where it is; without its
    line it travels to the changes. ``shards``: see :func:`in_shard`; ``leaves`` need them."""
    placed = in_shard(source.where(F.col("item_type").isin("EDGE", "RELATION")), shards)
    box = box_columns("s_")
    line = (F.col("item_type") == "EDGE") & F.col("geom").isNotNull()
    outside = F.when(line, ~polyline_meets_box(F.col("geom"), box)).otherwise(~F.coalesce(boxes_meet(box_columns(), box), F.lit(False)))
    relation = F.col("item_type") == "RELATION"
    if near is None and leaves is not None:
        near = _met(leaves, shapes, shards)
    out = placed.where(outside if near is None else ~relation & outside)
    if near is not None:
        out = out.unionByName(placed.where(relation).join(near, ["country", "shard", "id"], "left_anti").select(*placed.columns))
    out = _beside(change(out.select(*SHARDED), "REMOVE", "outside").select(*CHANGE), changes, changed=F.lit(True)).where("changed is null")
    if keep is not None:
        out = out.join(keep.select("id").distinct(), "id", "left_anti")
    return out.select(*CHANGE)


def filter_changes(
    changes: DataFrame, source: DataFrame | None, edges: DataFrame, shards: DataFrame, geometric: DataFrame | None = None, leaves: DataFrame | None = None, shapes: DataFrame | None = None, tiles: bool = False
) -> DataFrame:
    """P14, P15, P16, P19, P17, P18, then the generated removes (U5). P16 needs ``leaves`` and ``shapes``, see
    :func:`overlapping_relations`. Without a source only P14 (full changes) and P15. ``tiles``: shards are tiles, whose names give their boxes,
    see :func:`in_shard`. Nothing is stored between the filters, so that a caller that reads a few columns has no others written."""
    at = None if tiles else shards
    if source is None:
        empty = changes.limit(0).select(*SHARDED)
        return overlapping_edges(changes.where("full"), empty, at)
    kept = overlapping_edges(known_or_full(changes, source), source, at)
    if leaves is not None:
        kept = overlapping_relations(kept, leaves, shapes, shards)
    if geometric is not None:
        kept = without_geometric(kept, geometric)
    kept = own_nodes(own_removals(kept), edges, at)
    near = None if leaves is None else _met(leaves, shapes, shards)
    return kept.unionByName(generated_removes(kept, source, at, geometric, near=near))


# ---------------------------------------------------------------- application


def overlaid(source: DataFrame, changes: DataFrame) -> DataFrame:
    """The features after REMOVE deletes and ADD inserts or overlays the fields it sets, before any trimming. A relation's box is
    that of its change."""
    drawn = F.col("geom").isNotNull().alias("drawn")
    c = changes.select(*KEY, "change_type", "full", drawn, *[F.col(v).alias("new_" + v) for v in VIEW], *[F.col(b).alias("new_" + b) for b in BOX])
    both = source.select(*SHARDED, F.lit(True).alias("old")).join(c, KEY, "full_outer")
    both = both.where((F.coalesce("change_type", F.lit("")) != "REMOVE") & (F.col("old") | F.col("full")))
    view = [F.coalesce("new_" + v, v).alias(v) for v in VIEW]
    anew = F.coalesce("drawn", F.lit(False)) | (F.col("item_type") == "RELATION")
    boxes = [F.when(anew, F.coalesce("new_" + b, b)).otherwise(F.coalesce(b, "new_" + b)).alias(b) for b in BOX]
    return both.select(*KEY, *view, *boxes)


def apply_changes(source: DataFrame, changes: DataFrame, shards: DataFrame | None) -> DataFrame:
    """REMOVE deletes, ADD inserts or overlays the fields it sets; the result is trimmed to the shard's box. Shards
    without changes come out as they are (J6 and U1 in one join). Features with members, or with edges and their nodes, are
    applied by :func:`quadra.operators.graph.apply_graph`. ``shards``: see :func:`in_shard`."""
    return in_shard(overlaid(source, changes), shards).where(boxes_meet(box_columns(), box_columns("s_"))).select(*SHARDED)


def untouched(shards: DataFrame, changes: DataFrame) -> DataFrame:
    """Shards without a change."""
    return shards.join(changes.select("country", "shard").distinct(), ["country", "shard"], "left_anti")


def new_shards(changes: DataFrame, source: DataFrame) -> DataFrame:
    """(country, shard) that did not exist and can be made, since one of their changes is a full ADD."""
    made = changes.groupBy("country", "shard").agg(F.max((F.col("change_type") == "ADD") & F.col("full")).alias("ok")).where("ok")
    return made.select("country", "shard").join(source.select("country", "shard").distinct(), ["country", "shard"], "left_anti")


def changes_with_neighbours(changes: DataFrame, groups: DataFrame) -> DataFrame:
    """Changes keep their row where their shard has no data. ``groups``: (country, shard, features)."""
    return changes.join(groups, ["country", "shard"], "left")


def side_output(features: DataFrame, rule: Column) -> DataFrame:
    """C11: what a later level reads of its neighbours."""
    return features.where(rule)


# ---------------------------------------------------------------- graph


def connected_edges(ids: DataFrame, source: DataFrame, added: DataFrame) -> DataFrame:
    """(node_id, edge_id) at the nodes of ``ids`` (J16); edges that the source lacks are looked up among the added ones."""
    every = source.select("id", "start_node", "end_node").unionByName(added.select("id", "start_node", "end_node").join(source.select("id"), "id", "left_anti"))
    ends = every.select(F.col("id").alias("edge_id"), F.explode(F.array_distinct(F.array("start_node", "end_node"))).alias("node_id"))
    return ends.join(ids.select("node_id").distinct(), "node_id", "left_semi")


def floaters(edges: DataFrame) -> DataFrame:
    """(id) of edges that share no node with another way's edge (J17); an edge and its reverse are one."""
    ends = edges.select(F.abs("id").alias("e"), F.explode(F.array_distinct(F.array("start_node", "end_node"))).alias("node")).distinct()
    met = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node")
    tied = ends.join(met, "node", "left_semi").select("e").distinct()
    return edges.select("id", F.abs("id").alias("e")).join(tied, "e", "left_anti").select("id")


def floater_removes(edges: DataFrame) -> DataFrame:
    """(item_type, id, change_type): the removal of each floating edge, its reverse, and both of its nodes."""
    gone = edges.join(floaters(edges), "id", "left_semi")
    nodes = gone.select(F.explode(F.array("start_node", "end_node")).alias("id")).distinct()
    return gone.select(F.lit("EDGE").alias("item_type"), "id").unionByName(nodes.select(F.lit("NODE").alias("item_type"), "id")).withColumn("change_type", F.lit("REMOVE"))


def turn_restrictions(edges: DataFrame, valence: DataFrame, above: int) -> DataFrame:
    """(node_id, from_edge, to_edge): per node of a higher valence the pair of smallest ids that is no U-turn."""
    busy = valence.where(F.col("valence") > above).select("node_id")
    into = edges.select(F.col("end_node").alias("node_id"), F.col("id").alias("from_edge")).join(busy, "node_id", "left_semi")
    out = edges.select(F.col("start_node").alias("node_id"), F.col("id").alias("to_edge")).join(busy, "node_id", "left_semi")
    # the two smallest of each side are enough for a smallest pair without a U-turn
    a = into.groupBy("node_id").agg(F.slice(F.array_sort(F.collect_set("from_edge")), 1, 2).alias("f"))
    b = out.groupBy("node_id").agg(F.slice(F.array_sort(F.collect_set("to_edge")), 1, 2).alias("t"))
    pairs = a.join(b, "node_id").select("node_id", F.explode("f").alias("from_edge"), "t").select("node_id", "from_edge", F.explode("t").alias("to_edge"))
    first = pairs.where(F.col("from_edge") != -F.col("to_edge")).groupBy("node_id").agg(F.min(F.struct("from_edge", "to_edge")).alias("p"))
    return first.select("node_id", "p.from_edge", "p.to_edge")


def validate(features: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(problem, item_type, id): edges whose node is missing, relations whose member is missing."""
    ends = features.where("item_type = 'EDGE'").select("id", F.explode(F.array("start_node", "end_node")).alias("node_id"))
    lost = ends.join(nodes.select("node_id"), "node_id", "left_anti").select(F.lit("edge without node").alias("problem"), F.lit("EDGE").alias("item_type"), "id")
    there = features.select(F.col("item_type").alias("member_type"), F.col("id").alias("member_id"))
    gone = members.join(there, ["member_type", "member_id"], "left_anti").select(F.lit("member without feature").alias("problem"), F.lit("RELATION").alias("item_type"), F.col("relation_id").alias("id"))
    return lost.unionByName(gone).distinct()
