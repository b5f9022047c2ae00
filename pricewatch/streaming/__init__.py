"""Incremental results with Structured Streaming."""
