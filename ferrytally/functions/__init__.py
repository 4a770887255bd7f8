"""Column expressions: names, cells, types, bands."""
