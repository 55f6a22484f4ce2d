"""Registered queries, each with the DuckDB query that must give the same rows."""
