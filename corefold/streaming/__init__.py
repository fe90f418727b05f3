"""Incremental matching on Structured Streaming."""
