"""Structured Streaming: directory ingestion and trip streams."""
