"""Independent SQL for the registered queries, for comparison in DuckDB."""
