"""Column expressions; all built-in, none runs Python per row."""
