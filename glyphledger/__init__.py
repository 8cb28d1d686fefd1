"""Content-addressed asset registry on Spark DataFrames."""
