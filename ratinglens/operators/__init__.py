"""Batch, lookup, serving, series and cell operators (all lazy DataFrames)."""
