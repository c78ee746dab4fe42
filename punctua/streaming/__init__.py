"""Incremental ingest of newly landed archive files."""
