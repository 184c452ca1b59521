"""Catalog, snapshot and change-log sources; CSV, staged and JDBC sinks."""
