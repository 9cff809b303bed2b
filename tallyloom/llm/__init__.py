"""Operators for training-data pipelines: filters, deduplication, mixing, encoding, formatting."""
