"""Structured Streaming variants of the row-wise steps."""
