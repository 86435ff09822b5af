"""Structured Streaming forms of ingest, de-duplication, windows and thread updates."""
