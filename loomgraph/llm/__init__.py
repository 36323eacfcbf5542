"""Operators of a training-data pipeline (tokenize, search, deduplicate,
classify, pack, shard). Nothing else in the library imports this package."""
