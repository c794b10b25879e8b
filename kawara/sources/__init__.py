"""Readers: files to DataFrames with declared schemas, nothing inferred."""
