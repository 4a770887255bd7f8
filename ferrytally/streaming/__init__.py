"""Incremental stage loading with Structured Streaming."""
