"""Column expressions: each takes columns and returns a column, so they run inside generated code."""
