"""Collections, queries on them, and aggregation requests."""
