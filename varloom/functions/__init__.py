"""Scalar functions as Catalyst expressions."""
