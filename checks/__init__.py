"""Queries over the given test tables, and the same answers in SQL."""
