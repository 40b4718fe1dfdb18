"""Incremental ingest of newly arrived files."""
