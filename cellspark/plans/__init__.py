"""Dependencies between cells, evaluated level by level."""
