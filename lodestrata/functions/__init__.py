"""Column expressions: element rendering, sizes, chunk fold, tokens."""
