"""Readers, writers and named stages."""
