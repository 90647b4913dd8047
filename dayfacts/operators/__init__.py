"""DataFrame operators: revisions, intervals, completeness, lookups, quality, measures."""
