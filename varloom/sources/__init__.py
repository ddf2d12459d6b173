"""Scans of evidence, annotation and sequence files into typed DataFrames."""
