"""Readers and writers of the map engine's files."""
