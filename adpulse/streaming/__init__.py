"""Structured Streaming forms of the daily metrics."""
