"""Column-to-Column building blocks."""
