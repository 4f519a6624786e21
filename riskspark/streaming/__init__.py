"""Structured Streaming forms of the serving operators."""
