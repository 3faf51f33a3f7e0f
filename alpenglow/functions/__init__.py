"""Column expressions: scores, units, calendar arithmetic."""
