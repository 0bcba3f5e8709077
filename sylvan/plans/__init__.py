"""Composed query plans, the query registry and DuckDB oracle SQL."""
