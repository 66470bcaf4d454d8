"""Operators for training data: search, packing, dedup, scans, quality, tokens, shards, language."""
