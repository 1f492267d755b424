"""Review analytics on Spark: every step takes a DataFrame and returns a DataFrame."""
