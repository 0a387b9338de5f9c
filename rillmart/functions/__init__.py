"""Column-level helpers, all built from native Spark functions."""
