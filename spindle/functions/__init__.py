"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""
