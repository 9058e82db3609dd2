"""Column functions: text cleaning, vectors, and the per-page HTML helper."""
