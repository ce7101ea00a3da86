"""Column expressions and small row-local helpers."""
