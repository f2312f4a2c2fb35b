"""Structured Streaming: queries, progress, state checks."""
