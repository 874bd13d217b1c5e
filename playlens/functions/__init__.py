"""Column expressions and aggregate measures."""
