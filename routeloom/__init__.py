"""Route-delay graph analytics on Spark DataFrames."""
