"""Structured Streaming forms of the run-table operators."""
