"""Reusable operators, each a lazy function from DataFrames to a DataFrame."""
