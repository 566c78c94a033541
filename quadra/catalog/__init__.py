"""Registered queries by topic: each module has QUERIES (name -> function) and SQL (name -> DuckDB text)."""
