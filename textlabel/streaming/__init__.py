"""Streaming use of the stateless per-row operators."""
