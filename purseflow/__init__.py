"""Payments analytics on Spark DataFrames, Spark SQL and Structured Streaming."""
