"""Operators for training-data preparation at scale; nothing else in the library imports this."""
