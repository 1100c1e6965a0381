"""Structured Streaming versions of ingest, rollup and deduplication."""
