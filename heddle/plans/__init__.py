"""Plan reports."""
