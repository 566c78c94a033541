"""Predicates on tag maps and item types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM_TYPES = ["NODE", "EDGE", "AREA", "LINE", "POINT", "RELATION"]


def has_tag(key: str, value: str = "*", tags: str = "tags") -> Column:
    """``key->value`` (P8); the value ``*`` stands for any. Combine with ``&``, ``|`` and ``~``."""
    if value == "*":
        return F.coalesce(F.map_contains_key(tags, key), F.lit(False))
    return F.coalesce(F.try_element_at(F.col(tags), F.lit(key)) == value, F.lit(False))


def tag_filter(rule: str, tags: str = "tags") -> Column:
    """A filter text: ``key->value`` terms (``key->!`` for no such key), ``&`` for and, ``|`` for or (binds weaker)."""
    def term(text: str) -> Column:
        key, value = text.strip().split("->", 1)
        return ~has_tag(key, "*", tags) if value == "!" else has_tag(key, value, tags)

    either = None
    for clause in rule.split("|"):
        both = None
        for text in clause.split("&"):
            both = term(text) if both is None else both & term(text)
        either = both if either is None else either | both
    return either


@dataclass(frozen=True)
class NamedFilter:
    """Item types and a tag rule that must both hold (P9); None lets everything pass."""

    name: str
    types: tuple[str, ...] | None = None
    rule: str | None = None

    def column(self, item_type: str = "item_type", tags: str = "tags") -> Column:
        out = F.lit(True)
        if self.types is not None:
            out = out & F.col(item_type).isin(*self.types)
        if self.rule is not None:
            out = out & tag_filter(self.rule, tags)
        return out


def item_type_name(code: Column) -> Column:
    """0 to 5 as NODE, EDGE, AREA, LINE, POINT, RELATION (P7); another code is an error."""
    names = F.create_map(*[F.lit(x) for i, n in enumerate(ITEM_TYPES) for x in (i, n)])
    found = F.try_element_at(names, code)
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("not an item type: "), F.coalesce(code.cast("string"), F.lit("null")))))


def put_tag(tags: Column, key: str, value: Column) -> Column:
    """``tags[key] = value``."""
    return F.map_concat(F.map_filter(F.coalesce(tags, F.create_map().cast("map<string,string>")), lambda k, _: k != key), F.create_map(F.lit(key), value))


def tags_text(tags: Column) -> Column:
    """The map as sorted ``k=v`` text, for comparison and publishing."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
