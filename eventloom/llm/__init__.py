"""Operators for training-data pipelines: mixing, sharding, deduplication, extraction, filters."""
