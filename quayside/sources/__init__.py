"""Readers that return DataFrames."""
