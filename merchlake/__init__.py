"""Commerce analytics operators for Spark: DataFrames in, DataFrames out."""
