"""Operators for preparing training data: search, filtering, duplicates, tokens, shards."""
