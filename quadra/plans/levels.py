"""Mutations in levels: user functions over sharded features, run in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.functions.geometry import BOX, box_columns, boxes_meet
from quadra.functions.tags import has_tag, put_tag
from quadra.operators import changes as C
from quadra.operators import graph, spatial
from quadra.operators.snapshots import countries
from quadra.plans import build
from quadra.session import stored


@dataclass
class Context:
    """What a mutation may ask for: shards (country, shard, box), lookup tables by name, features of neighbouring shards, and the
    members of relations (graph.MEMBER), where there are any."""

    shards: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    level: int = 0
    features: DataFrame | None = None
    members: DataFrame | None = None
    #: Shards are tiles, whose names give their boxes, so that rows need not be joined with the table for them.
    tiles: bool = False

    @property
    def boxes(self) -> DataFrame | None:
        """What gives the boxes of rows' shards, see :func:`changes.in_shard`."""
        return None if self.tiles else self.shards

    def neighbours(self, metres: float, rule: Column | None = None) -> DataFrame:
        """(origin, sharded features): what the shards within a distance of each shard hold, itself included, at the start
        of the level (C6, J4). Only features that match ``rule`` are read of them (C11)."""
        some = self.features if rule is None else C.side_output(self.features, rule)
        return spatial.fetch(spatial.neighbours(self.shards, metres), some)

    def lookup(self, name: str, limit_bytes: int | None = None) -> DataFrame:
        """A table by name. It is left to Spark's size estimate whether it is sent to all tasks; a caller that
        knows the table's size can give ``limit_bytes`` to ask for it below that estimate."""
        df = self.tables[name]
        if limit_bytes is not None:
            size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            if size <= limit_bytes:
                return F.broadcast(df)
        return df


@dataclass(frozen=True)
class Mutation:
    """``run(features, context)`` returns changes (columns of changes.CHANGE). ``members(features, context)`` returns the new
    member lists (graph.MEMBER) of relations that it adds again, each as whole as its shard has it."""

    name: str
    run: Callable[[DataFrame, Context], DataFrame]
    depends: tuple[str, ...] = ()
    enabled: bool = True
    include: tuple[str, ...] | None = None
    exclude: tuple[str, ...] | None = None
    policy: C.MergePolicy = C.MergePolicy()
    members: Callable[[DataFrame, Context], DataFrame] | None = None


def order_levels(mutations: list[Mutation]) -> list[list[Mutation]]:
    """A mutation runs one level after the last of its dependencies; unknown and disabled ones are ignored. A cycle is
    an error."""
    known = {m.name: m for m in mutations if m.enabled}
    level: dict[str, int] = {}

    def of(name: str, above: tuple[str, ...]) -> int:
        if name in above:
            raise ValueError(f"mutations depend on each other: {' -> '.join((*above, name))}")
        if name not in level:
            level[name] = 1 + max((of(d, (*above, name)) for d in known[name].depends if d in known), default=-1)
        return level[name]

    for name in known:
        of(name, ())
    return [[known[n] for n in sorted(known) if level[n] == i] for i in range(max(level.values(), default=-1) + 1)]


def generate(features: DataFrame, mutations: list[Mutation], context: Context, only: Column | None = None) -> DataFrame:
    """Changes of a level's mutations, each merged by its own policy (A7), as made (before assignment). ``only``: a filter
    on features, such as one shard (C13) or the include lists (P28)."""
    source, out = features if only is None else features.where(only), None
    context = replace(context, features=features)
    for m in mutations:
        made = m.run(countries(source, m.include, m.exclude), context).select(*C.CHANGE).withColumns({"mutation": F.lit(m.name), "level": F.lit(context.level)})
        made = C.merge(made, m.policy, ["mutation"])
        out = made if out is None else out.unionByName(made)
    return out


def run_level(features: DataFrame, mutations: list[Mutation], context: Context, policy: C.MergePolicy = C.MergePolicy(), only: Column | None = None, geometric: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(features after, changes applied): generate (mutations fetch what they need of neighbouring shards), keep to the
    source shard, assign, merge, filter, apply."""
    made = stored(C.inside_source(generate(features, mutations, context, only), context.boxes), "made")
    merged = stored(C.merge(C.assign_once(made, context.shards), policy), "merged")
    edges = features.where("item_type = 'EDGE'").select("id", "start_node", "end_node", "geom")
    kept = stored(C.filter_changes(merged, features, edges, context.shards, geometric, tiles=context.tiles), "kept")
    return C.apply_changes(features, C.with_mutation_tags(kept, features), context.boxes), kept


def member_lists(features: DataFrame, mutations: list[Mutation], context: Context, only: Column | None = None) -> DataFrame:
    """graph.MEMBER and mutation: the member lists that a level's mutations make."""
    source = features if only is None else features.where(only)
    out = context.members.select(*graph.MEMBER, F.lit(None).cast("string").alias("mutation")).limit(0)
    context = replace(context, features=features)
    for m in mutations:
        if m.members is not None:
            made = m.members(countries(source, m.include, m.exclude), context)
            out = out.unionByName(made.select(*graph.MEMBER, F.lit(m.name).alias("mutation")))
    return out


def run_level_graph(features: DataFrame, mutations: list[Mutation], context: Context, policy: C.MergePolicy = C.MergePolicy(), only: Column | None = None, geometric: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C12 for nodes, edges and relations: (features after, members after, changes applied). As :func:`run_level`, with
    ``context.members``, member lists merged as differences, relations filtered by shape, and the soft cut."""
    made = stored(C.inside_source(generate(features, mutations, context, only), context.boxes), "made")
    merged = stored(C.merge(C.assign_once(made, context.shards), policy), "merged")
    lists = stored(member_lists(features, mutations, context, only), "lists")
    deltas = stored(graph.member_deltas(lists, context.members), "deltas")
    brought = stored(graph.brought_members(lists, merged), "brought")
    kept = stored(graph.filter_graph(merged, features, context.members, brought, context.boxes, geometric), "kept")
    after = graph.members_after(context.members, brought, deltas, kept)
    done, held = graph.apply_graph(features, after, C.with_mutation_tags(kept, features), context.boxes)
    return done, held, kept


def run_levels_graph(features: DataFrame, mutations: list[Mutation], context: Context, policy: C.MergePolicy = C.MergePolicy(), start: int = 0, stop: int | None = None, only: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(features, members) after all levels from ``start`` to ``stop``, see :func:`run_levels` and :func:`run_level_graph`."""
    members = context.members
    for i, level in enumerate(order_levels(mutations)):
        if i < start or (stop is not None and i > stop):
            continue
        features, members, _ = run_level_graph(features, level, replace(context, level=i, members=members), policy, only)
        features, members = stored(features, f"level-{i}"), stored(members, f"members-{i}")
    return features, members


def run_levels(features: DataFrame, mutations: list[Mutation], context: Context, policy: C.MergePolicy = C.MergePolicy(), start: int = 0, stop: int | None = None, only: Column | None = None) -> DataFrame:
    """All levels from ``start`` to ``stop`` (P28) in turn; each level's result is a stored table, which ends its lineage."""
    for i, level in enumerate(order_levels(mutations)):
        if i < start or (stop is not None and i > stop):
            continue
        features, _ = run_level(features, level, replace(context, level=i), policy, only)
        features = stored(features, f"level-{i}")
    return features


# ---------------------------------------------------------------- ready-made mutations


def add_tag(rule: Column, key: str, value: str, name: str = "add_tag") -> Mutation:
    return Mutation(name, lambda f, _: C.change(f.where(rule), "ADD", name, tags=put_tag(F.col("tags"), key, F.lit(value))))


def add_shard_tags(rule: Column, key: str = "shard", name: str = "add_shard_tags") -> Mutation:
    return Mutation(name, lambda f, _: C.change(f.where(rule), "ADD", name, tags=put_tag(F.col("tags"), key, F.col("shard"))))


def remove_points(key: str, value: str = "*", name: str = "remove_points") -> Mutation:
    return Mutation(name, lambda f, _: C.change(f.where((F.col("item_type") == "POINT") & has_tag(key, value)), "REMOVE", name))


def self_conflicting(rule: Column, name: str = "self_conflicting", policy: C.MergePolicy = C.MergePolicy()) -> Mutation:
    """Adds and removes the same features; without a policy that is an error."""
    return Mutation(name, lambda f, _: C.change(f.where(rule), "ADD", name).unionByName(C.change(f.where(rule), "REMOVE", name)), policy=policy)


def tag_near(rule: Column, other: Column, metres: float, key: str, value: str = "yes", name: str = "tag_near") -> Mutation:
    """Tags the features of ``rule`` in shards that hold a feature of ``other``, or have one in a shard within the distance."""

    def run(features: DataFrame, context: Context) -> DataFrame:
        near = context.neighbours(metres, other).select("country", F.col("origin").alias("shard")).distinct()
        return C.change(features.where(rule).join(near, ["country", "shard"], "left_semi"), "ADD", name, tags=put_tag(F.col("tags"), key, F.lit(value)))

    return Mutation(name, run)


def tag_bus_stops(name: str = "tag_bus_stops") -> Mutation:
    stop = has_tag("highway", "bus_stop") | has_tag("amenity", "bus_station")
    return Mutation(name, lambda f, _: C.change(f.where((F.col("item_type") == "POINT") & stop), "ADD", name, tags=put_tag(F.col("tags"), "public_transport", F.lit("stop_position"))))


def shard_features(features: DataFrame, tiles: DataFrame, boundaries: DataFrame, *more: str, boxed: bool = False) -> DataFrame:
    """Features (item_type, id, geom, tags, start_node, end_node, box) dealt to (country, shard): to each shard that their
    box meets, in each country that meets both. E6: the user gets the countries' shards with it. ``more``: further columns to keep.
    ``boxed``: with the shard's box (changes.SHARD_BOX)."""
    listed = spatial.country_shards(tiles, boundaries, BOX).join(boundaries.select("country", *[F.col(c).alias("k_" + c) for c in BOX]), "country")
    listed = stored(listed.select("country", F.concat_ws("-", "zoom", "x", "y").alias("shard"), *BOX, *["k_" + c for c in BOX]), "listed")
    pairs = spatial.join_cells(features.select("item_type", "id", *C.VIEW, *BOX, *more), listed).where(boxes_meet(box_columns("a_"), box_columns("b_k_")))
    own = [F.col("b_" + c).alias("s_" + c) for c in BOX] if boxed else []
    return pairs.select(*[F.col(("b_" if c in ("country", "shard") else "a_") + c).alias(c) for c in [*C.SHARDED, *more]], *own)


def shard_graph(features: DataFrame, edges: DataFrame, nodes: DataFrame, tiles: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Features, edges and nodes dealt to shards like :func:`shard_features`, all at once; a shard also has the nodes of its edges that lie
    outside of it. ``features`` and ``nodes`` have the columns of features, ``edges`` are those of :func:`build.forward_edges`: they are
    dealt, and stored, without their reverses."""
    columns = ["item_type", "id", *C.VIEW, *BOX]
    one = F.lit(False).alias("both")
    every = features.select(*columns, one).unionByName(nodes.select(*columns, one)).unionByName(edges.select(*columns, "both"))
    placed = stored(shard_features(every, tiles, boundaries, "both"), "placed")
    ends = placed.where("item_type = 'EDGE'").select("country", "shard", F.explode(F.array("start_node", "end_node")).alias("id")).distinct()
    own = placed.where("item_type = 'NODE'").select("country", "shard", "id")
    outside = stored(ends.join(own, ["country", "shard", "id"], "left_anti").join(nodes.select(*columns), "id").select(*C.SHARDED), "outside")
    return build.both_ways(placed).select(*C.SHARDED).unionByName(outside)
