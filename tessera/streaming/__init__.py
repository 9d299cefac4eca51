"""Structured Streaming form of the raw → Silver transform (M1)."""
