"""Structured Streaming variants of the load."""
