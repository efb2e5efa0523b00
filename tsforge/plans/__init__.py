"""Composable workflows and the registry of named queries + DuckDB oracles."""
