"""Structured Streaming versions of operators whose inputs keep arriving."""
