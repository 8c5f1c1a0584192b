"""Column-level rules: every function takes and returns Spark columns."""
