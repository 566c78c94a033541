"""Column functions: tiles, geometry, tags and record keys."""
