"""Operators for training-data pipelines: deduplication, language, tokens, packing,
nearest neighbours, URL rules and HTML extraction."""
