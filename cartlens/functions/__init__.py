"""Column and ordering helpers shared by the operators."""
