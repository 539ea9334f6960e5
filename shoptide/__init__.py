"""Retail behaviour and recommendation analytics on Spark DataFrames."""
