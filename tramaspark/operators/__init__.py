"""DataFrame operators: nested records, hierarchies, places, matching and graph merging."""
