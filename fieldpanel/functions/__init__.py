"""Column-level functions and fixed lookup values."""
