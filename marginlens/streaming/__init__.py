"""Incremental (Structured Streaming) form of the ingest -> Silver path."""
