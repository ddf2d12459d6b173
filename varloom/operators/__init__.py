"""Relational operators that DataFrames lack, as compositions of those they have."""
