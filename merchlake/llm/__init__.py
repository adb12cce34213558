"""Operators for preparing language-model training data: scoring, filtering, deduplication, mixing."""
