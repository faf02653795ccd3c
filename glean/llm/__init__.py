"""Operators for training-data pipelines (near-duplicates, quality, secrets, packing, ...)."""
