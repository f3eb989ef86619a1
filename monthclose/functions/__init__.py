"""Column functions and month parameters."""
