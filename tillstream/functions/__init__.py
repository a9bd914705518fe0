"""Column-level helpers: JSON codec, clock arithmetic, money arithmetic."""
