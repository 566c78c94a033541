"""Operators over map tables: entities, spatial joins, relations, changes, snapshots."""
