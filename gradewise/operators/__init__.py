"""Operators over DataFrames: reports, merge, sessions and quality checks."""
