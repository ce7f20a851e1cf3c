"""Column expressions: tags, grids, geometry and arrays."""
