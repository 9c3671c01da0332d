"""Incremental file ingest with Structured Streaming."""
