"""Incremental forms of ingest and URL de-duplication."""
