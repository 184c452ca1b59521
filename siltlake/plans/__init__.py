"""Named queries (with DuckDB oracles) and the fixtures they derive from the given tables."""
