"""DataFrame operators: cleaning, deduplication, lookups, keys, merges, quality checks."""
