"""Column expressions: time keys, record keys, measures, distances."""
