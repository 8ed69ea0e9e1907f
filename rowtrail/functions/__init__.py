"""Column expressions shared by the operators (all built-in, no Python UDF)."""
