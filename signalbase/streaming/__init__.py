"""Structured Streaming forms of deduplication, loading and health windows."""
