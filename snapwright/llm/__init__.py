"""Operators for training data: extraction, filtering, de-duplication, formatting, packing and search."""
