"""Structured Streaming forms of the table operators."""
