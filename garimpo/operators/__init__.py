"""DataFrame operators: keyed merges, lookups, entity resolution, quality."""
