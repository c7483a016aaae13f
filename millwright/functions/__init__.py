"""Column expressions; all built-in functions, no Python per row."""
