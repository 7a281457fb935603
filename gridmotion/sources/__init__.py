"""Readers, writers and the ingest job."""
