"""Structured Streaming form of the ingest path."""
