"""Operators over document collections for training-data preparation."""
