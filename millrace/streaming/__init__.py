"""Structured Streaming forms of the record and message operators."""
