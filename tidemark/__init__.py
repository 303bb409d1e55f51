"""Spark-native analytics for quality-gating sampled time-series media and text corpora."""
