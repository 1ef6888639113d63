"""Operators for training-data pipelines: quality, deduplication, language models, packing and mixing."""
