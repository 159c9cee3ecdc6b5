"""Operators for building training data: cleaning, deduplication, mixing, sharding."""
