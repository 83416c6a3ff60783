"""Registered queries over the driver fixtures and their DuckDB oracles."""
