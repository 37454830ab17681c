"""Relational operators: every function maps DataFrames to DataFrames."""
