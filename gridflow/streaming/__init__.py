"""Structured Streaming queries built from the same transforms."""
