"""Operators for training-data preparation. Nothing outside imports this."""
