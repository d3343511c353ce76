"""Incremental ingest of the raw feed with Structured Streaming."""
