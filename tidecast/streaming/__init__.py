"""Structured Streaming forms."""
