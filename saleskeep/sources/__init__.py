"""Readers, writers and data generators."""
