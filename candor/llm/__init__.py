"""Operators of a training-data pipeline: extraction, filters, near duplicates, shards, mixing, tokens, search."""
