"""Structured Streaming twins of the journal's reductions."""
