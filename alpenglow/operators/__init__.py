"""Reusable table operators: flattening payloads, table state, quality checks, profiles."""
