"""Incremental loading of bronze objects with Structured Streaming."""
