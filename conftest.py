"""Puts the repository root on the path of the tests."""
