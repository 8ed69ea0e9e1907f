"""Structured Streaming queries over change feeds."""
