"""Operators on event DataFrames."""
