"""Operators: pure functions from DataFrames and arguments to DataFrames."""
