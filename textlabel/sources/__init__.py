"""Corpus readers and result writers."""
