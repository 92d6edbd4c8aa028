"""Operators for training-data pipelines: search, deduplication, packing,
tokens, scoring, filtering and formatting over documents, embeddings and
conversations."""
