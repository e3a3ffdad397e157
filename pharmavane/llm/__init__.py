"""Preparation of training text: mixing, deduplication, tokens, quality, shards."""
