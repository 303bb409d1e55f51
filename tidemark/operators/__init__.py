"""Operators over clip timelines and signals, as functions from DataFrames to DataFrames."""
