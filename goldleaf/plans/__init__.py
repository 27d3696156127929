"""Pipelines (silver, gold), the query catalogue and its DuckDB oracle."""
