"""Feeds as Structured Streaming."""
