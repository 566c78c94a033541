"""All registered queries of the map engine, by operator id."""

from __future__ import annotations

from quadra.catalog import edits, features, files, graphs, tiles

MODULES = [tiles, features, edits, files, graphs]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
