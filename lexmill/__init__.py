"""Document-corpus analytics on Spark: stages from DataFrame to DataFrame."""
