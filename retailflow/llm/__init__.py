"""Operators of a training-data pipeline: token counts, packing, repeated
passages, exact top-k search, toxicity, source mixing, URL filters,
near-duplicates (texts and embeddings) and personal data."""
