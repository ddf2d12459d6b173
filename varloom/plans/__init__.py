"""Whole plans: queries, annotation, builders, packaging and checks."""
