"""Variant-to-protein analytics on Spark DataFrames."""
