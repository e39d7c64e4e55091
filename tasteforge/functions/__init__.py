"""Column functions: each takes and gives Columns, so they stay inside generated code."""
