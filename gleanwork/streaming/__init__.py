"""Structured Streaming forms of the attempt-log operators."""
