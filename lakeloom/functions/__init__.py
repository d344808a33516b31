"""Column expressions (Column -> Column)."""
