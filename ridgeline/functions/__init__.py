"""Column functions: names, pixels, vectors and relative change."""
