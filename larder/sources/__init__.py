"""Reading, writing and locating tables."""
