"""DataFrame-to-DataFrame transforms of each layer."""
