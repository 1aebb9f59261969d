"""Incremental versions of ingest and the tape fold."""
