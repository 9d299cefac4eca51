"""Operators of a training-data pipeline: deduplication, search, filtering, tokens."""
