"""Operators for preparing training data: indexes, near copies, filters, tokens, shards."""
