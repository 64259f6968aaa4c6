"""Operators beyond a single expression."""
