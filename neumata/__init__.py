"""Symbolic-sequence analytics and corpus preparation on Spark DataFrames."""
