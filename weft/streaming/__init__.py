"""Structured Streaming ingest: file folders -> bronze -> silver."""
