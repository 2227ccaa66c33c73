"""Incremental ingest of landed payload files with Structured Streaming."""
