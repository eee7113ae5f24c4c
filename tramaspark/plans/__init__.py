"""Named queries: each takes (spark, directory) and returns a DataFrame."""
