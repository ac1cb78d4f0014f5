"""Point-in-time analytics over event streams, on Spark DataFrames."""
