"""Readers, tables, clustered tables and storage locations."""
