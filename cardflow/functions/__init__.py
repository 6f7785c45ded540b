"""Column expressions: no job runs here and no Python runs per row."""
