"""Column -> Column functions: no shuffles, no Python workers."""
