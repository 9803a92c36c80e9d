"""Keys, lookups, dimension loads, fact loads and data checks."""
