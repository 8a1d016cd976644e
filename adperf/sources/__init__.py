"""Readers, writers, schemas and the adapters onto the test tables."""
