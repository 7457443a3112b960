"""Operators for training-data pipelines: quality, deduplication, tokens, languages, mixing."""
