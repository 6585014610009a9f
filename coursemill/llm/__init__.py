"""Operators for training-data pipelines: deduplication, quality, archives, tokens, mixing, search and scoring."""
