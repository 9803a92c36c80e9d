"""Dimensional warehouse toolkit on Spark DataFrames."""
