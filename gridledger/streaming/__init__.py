"""Incremental ingest of result files."""
