"""Pay analytics over job advertisements, on Spark DataFrames."""
