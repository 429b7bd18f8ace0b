"""Operators for preparing training text: quality, filters, duplicates, leaks, secrets, language, scores, shards, tokens."""
