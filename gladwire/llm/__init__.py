"""Operators for training-data corpora: scoring, secrets, shards, duplicates, tokens."""
