"""Operators of the engine, each a function from DataFrames to a DataFrame."""
