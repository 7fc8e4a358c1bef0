"""Testbed: raw card entities derived from the driver's tables, the registered
queries over them, and the independent DuckDB oracle for each query."""
