"""Advertising-performance analytics on Spark DataFrames."""
