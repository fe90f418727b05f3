"""Operators of the record-linkage pipeline: DataFrames in, DataFrames out."""
