"""Operators: each takes DataFrames and returns DataFrames (or Columns)."""
