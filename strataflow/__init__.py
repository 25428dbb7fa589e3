"""Layered analytics for field data on Spark DataFrames."""
