"""Relational and ML operators: DataFrames in, DataFrames out."""
