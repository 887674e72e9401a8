"""Streaming queries over the shared operators."""
