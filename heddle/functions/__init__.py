"""Column and aggregate helpers."""
