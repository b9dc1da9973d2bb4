"""Column functions: scalars, JSON text and aggregates."""
