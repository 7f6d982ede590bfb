"""Operators over DataFrames; see the modules of this package."""
