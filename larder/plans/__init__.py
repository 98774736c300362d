"""Named queries with their cross-checking SQL, and the table loaders."""
