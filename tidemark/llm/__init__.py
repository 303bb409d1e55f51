"""Operators for preparing training text: scoring, joins, scans, extraction and packing."""
