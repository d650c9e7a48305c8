"""DataFrame operators: every function maps DataFrames to a lazy DataFrame."""
