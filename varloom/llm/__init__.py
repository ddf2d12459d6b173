"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and ``/__spark_entry__.py`` adds them when the folder is present.
"""
