"""Operators for training-data pipelines: near duplicates, filters, archives, tokens."""
