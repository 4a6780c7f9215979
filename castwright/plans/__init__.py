"""Registered queries over the shipped tables, their DuckDB statements, and whole runs."""
