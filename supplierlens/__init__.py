"""Supplier performance analytics on Spark DataFrames."""
