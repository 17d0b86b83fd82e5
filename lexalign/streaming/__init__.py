"""Structured Streaming forms of the progress operators."""
