"""Incremental file ingest and continuous merges."""
