"""Operators for training-data pipelines: sanitising, tokenising, near-duplicates, search, packing, scoring."""
