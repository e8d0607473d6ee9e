"""Structured Streaming ingest built from the same column expressions as the batch code."""
