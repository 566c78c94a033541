"""Composed pipelines: feature building and mutation levels."""
