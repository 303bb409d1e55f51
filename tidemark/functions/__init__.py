"""Column builders: dimensions, parsing, comparison, geometry, validation."""
