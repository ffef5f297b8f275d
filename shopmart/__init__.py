"""Batch analytics for marketplace data on Spark DataFrames."""
