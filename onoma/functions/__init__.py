"""Column expressions: names, readings, years, identifiers and descriptive texts."""
