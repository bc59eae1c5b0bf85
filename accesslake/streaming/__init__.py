"""Continuous versions of ingest, de-duplication and roll-up."""
