"""Operators for large text corpora: filtering, near copies, tokenising, language models."""
