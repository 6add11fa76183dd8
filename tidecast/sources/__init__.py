"""Readers and record parsers."""
