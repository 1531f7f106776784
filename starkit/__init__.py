"""Build and query a star-schema data lake with Spark DataFrames."""
