"""Operators of a training-data pipeline: language, duplicates, archives, tokens, leaks, toxicity, privacy and quality."""
