"""DataFrame computations on franchise tables."""
