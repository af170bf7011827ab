"""Structured Streaming forms of the run."""
