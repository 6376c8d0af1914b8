"""Incremental ingestion of landed bronze files with Structured Streaming."""
