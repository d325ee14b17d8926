"""Operators of a training-data pipeline: search, tokens, mixing, packing, deduplication, scoring, archives, shards."""
