"""Incremental (file-arrival) ingestion with Structured Streaming."""
