"""Column-level building blocks (built-in expressions only, no UDF)."""
