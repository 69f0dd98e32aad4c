"""Batch and stream transformations; each takes and returns DataFrames."""
