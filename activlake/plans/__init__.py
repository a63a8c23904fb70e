"""Layer-by-layer runs over stored tables."""
